"""Scalar text, date and URL rules as native Column expressions (no UDFs).

Java regexes differ from Python's: ``\\w``, ``\\s`` and ``.`` are spelled out below so
that the rules behave like the Python ones they must match.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- character classes with Python 3 semantics -------------------------------------------
# Python's \w (str.isalnum() or '_').
WORD = r"[\p{L}\p{N}_]"
WORD_CHARS = r"\p{L}\p{N}_"
# Python's \s (str.isspace()): ASCII whitespace, \x1c-\x1f, NEL, NBSP and the Unicode spaces.
SPACE_CHARS = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
               r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
SPACE = f"[{SPACE_CHARS}]"
NON_SPACE = f"[^{SPACE_CHARS}]"
# White space other than the plain space.
NOT_A_SPACE = f"[{SPACE_CHARS.replace(' ', '')}]"
# The same characters written out, for trimming without a regex.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                           0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# --- fixed values that must equal the reference's -----------------------------------------
# Single-character Hanja -> Hangul map used before cleaning. The two-character key
# "農心" -> "농심" exists in the source map but can never apply, because the
# conversion looks at one character at a time; it is kept here for the record only.
HANJA_TO_HANGUL = {
    "中": "중국", "美": "미국", "日": "일본", "亞": "아시아", "人": "사람", "企": "기업", "來": "오다",
    "價": "값", "兆": "조", "免": "면제", "協": "협력", "印": "인도", "反": "반대", "多": "많다",
    "女": "여성", "尹": "윤석열", "弗": "달러", "後": "후", "農心": "농심", "故": "고인",
    "月": "달", "李": "이재명", "株": "주식", "比": "대비", "洪": "홍준표", "獨": "독일", "發": "발",
    "社": "회사", "行": "행", "證": "증권", "車": "자동차", "軍": "군대", "辛": "신", "農": "농업",
    "重": "무거움", "金": "금", "韓": "한국",
}
# Symbols removed verbatim by the cleaner.
REMOVED_SYMBOLS = ["△", "◇", "■"]
# News meta lines removed to the end of the line (label, separator).
META_RULES = [("사진", "="), ("출처", ":"), ("기자", "="), ("제보", "="), ("이메일", ":")]
# The Kakao rule removes "카카오톡 : @id"; the earlier @id rule always fires first.
KAKAO_LABEL = "카카오톡"
# Day-half words of the Korean date format "YYYY.MM.DD. 오전|오후 h:mm".
AM, PM = "오전", "오후"
# Tokens that mark an empty image value (compared lower-cased after stripping).
EMPTY_TOKENS = ["nan", "none", "null", "na", "nat"]
# Tokens blanked by the image-url normaliser (exact, case-sensitive).
NORMALISED_EMPTY = ["nan", "NaN", "None"]
# Values the SQL image update treats as empty.
SQL_EMPTY = ["", "nan"]
# Prefix of an LLM answer that reports a failed call.
FAILURE_MARK = "[요약 실패"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_py(col) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.btrim(_c(col), F.lit(SPACES))


def _when(text, found, rule) -> Column:
    """``rule(text)`` where ``found(text)``, else ``text``: a cheap test keeps a costly rule off
    the texts that it cannot change. The one-element array gives ``text`` a name, so it is
    computed once however often it is used."""
    return F.get(F.transform(F.array(_c(text)), lambda t: F.when(found(t), rule(t)).otherwise(t)), F.lit(0))


def _has(*marks: str):
    def found(t):
        any_of = F.contains(t, F.lit(marks[0]))
        for m in marks[1:]:
            any_of = any_of | F.contains(t, F.lit(m))
        return any_of
    return found


def _beyond_ascii(t) -> Column:
    return F.octet_length(t) > F.length(t)


def remove_brackets(col) -> Column:
    """P-1: drop every ``[...]`` (shortest, single line) and strip."""
    return strip_py(F.regexp_replace(_c(col), r"(?d)\[.*?\]", ""))


def hanja_to_hangul(col) -> Column:
    """P-3: per-character Hanja replacement. Values contain no keys, so sequential
    replacement equals a simultaneous one."""
    keys = [k for k in HANJA_TO_HANGUL if len(k) == 1]

    def replaced(out):
        for k in keys:
            out = F.replace(out, F.lit(k), F.lit(HANJA_TO_HANGUL[k]))
        return out
    return _when(col, lambda t: _beyond_ascii(t) & t.rlike(f"[{min(keys)}-{max(keys)}]"), replaced)


def clean_content(col) -> Column:
    """P-2: ordered cleaning rules; null stays null."""
    def drop(pattern):
        return lambda t: F.regexp_replace(t, pattern, "")
    # e-mail, optionally with a space on either side of '@' (starts at a word start)
    t = _when(col, _has("@"), lambda t: drop(f"@{WORD}+")(
        drop(f"(?<!{WORD}){WORD}[{WORD_CHARS}.-]* ?@ ?[{WORD_CHARS}.-]+\\.{WORD}+")(t)))
    t = _when(t, _has("http", "url.kr/"), drop(f"https?://{NON_SPACE}+|url\\.kr/{NON_SPACE}+"))

    def symbols(t):
        for sym in REMOVED_SYMBOLS:
            t = F.replace(t, F.lit(sym), F.lit(""))
        return t
    t = _when(t, _beyond_ascii, symbols)
    t = _when(t, _has("["), drop(r"(?d)\[.*?\]"))
    t = _when(t, _beyond_ascii, drop("[\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{F900}-\\x{FAFF}]"))
    t = _when(t, _has("※"), drop("(?d)※.*"))
    for label, sep in META_RULES:
        t = _when(t, _has(label), drop(f"(?d){label}{SPACE}*{sep}{SPACE}*.*"))
    t = _when(t, _has(KAKAO_LABEL), drop(f"{KAKAO_LABEL}{SPACE}*:{SPACE}*@{WORD}+"))
    for mark in ("ⓒ", "▲"):
        t = _when(t, _has(mark), drop(f"{mark}[^.\\n]*[.\\n]?"))
    t = F.replace(t, F.lit("\\'"), F.lit("'"))
    # runs of white space but a single space, which stays as it is; then only spaces are left
    t = F.regexp_replace(t, f" {SPACE}+|{NOT_A_SPACE}{SPACE}*", " ")
    return F.trim(t)


def fill_str(col) -> Column:
    """Null -> '' (``fillna('').astype(str)``)."""
    return F.coalesce(_c(col).cast("string"), F.lit(""))


def korean_datetime(col) -> Column:
    """P-4: ``YYYY.MM.DD. 오전|오후 h:mm`` (end not anchored) -> TIMESTAMP_NTZ, else null."""
    s = strip_py(_c(col))
    pat = f"^([0-9]{{4}})\\.([0-9]{{2}})\\.([0-9]{{2}})\\.{SPACE}*({AM}|{PM}){SPACE}*([0-9]+):([0-9]+)"

    def g(i):
        return F.regexp_extract(s, pat, i)

    ok = s.rlike(pat)
    hour = g(5).try_cast("int")
    hour = (F.when((g(4) == AM) & (hour == 12), F.lit(0))
            .when((g(4) == PM) & (hour != 12), hour + 12)
            .otherwise(hour))
    minute = g(6).try_cast("int")
    ts = F.try_make_timestamp_ntz(g(1).try_cast("int"), g(2).try_cast("int"), g(3).try_cast("int"),
                                  hour, minute, F.lit(0))
    return F.when(ok, ts)


def lenient_timestamp(col) -> Column:
    """P-5: lenient parse (ISO-like), null on failure."""
    return F.try_to_timestamp(_c(col)).cast("timestamp_ntz")


def two_format_timestamp(col) -> Column:
    """P-6: ``%Y-%m-%d %H:%M:%S`` then ``%Y-%m-%d %H:%M``, null when neither parses."""
    c = _c(col)
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")),
                      F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm"))).cast("timestamp_ntz")


def regex_tokens(col) -> Column:
    """P-11 built-in tokenizer: lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(f"{WORD}{{2,}}"), 0)


def parse_list_literal(col) -> Column:
    """P-12: a Python list literal of strings -> ARRAY<STRING>; None becomes a null element."""
    options = {"allowSingleQuotes": "true"}
    bare_none = F.regexp_replace(_c(col), r"(?<=[\[,\s])None(?=[\],\s])", "null")
    return F.coalesce(F.from_json(_c(col), "array<string>", options), F.from_json(bare_none, "array<string>", options))


def parse_vector_text(col) -> Column:
    """P-13: numpy-printed vector ``[a b\\n c]`` -> ARRAY<FLOAT>."""
    body = F.regexp_replace(_c(col), r"^[\[\] ]+|[\[\] ]+$", "")
    parts = F.filter(F.split(body, f"{SPACE}+"), lambda x: x != "")
    return F.transform(parts, lambda x: x.try_cast("float"))


def vector_text(col) -> Column:
    """Inverse of P-13 for writing vectors as text cells."""
    return F.concat(F.lit("["), F.array_join(F.transform(_c(col), lambda x: x.cast("string")), " "),
                    F.lit("]"))


def nonempty_text(col) -> Column:
    """P-14: not null and not blank after stripping."""
    return _c(col).isNotNull() & (F.length(strip_py(_c(col))) > 0)


# --- P-16: the three emptiness tests ---------------------------------------------------------
def is_empty_image(col) -> Column:
    """Null, blank, or one of the empty tokens (case-insensitive)."""
    s = F.lower(strip_py(_c(col).cast("string")))
    return _c(col).isNull() | (s == "") | s.isin(EMPTY_TOKENS)


def normalise_image_url(col) -> Column:
    """Cast to text, strip, blank exactly nan/NaN/None; null is printed as 'None'."""
    s = strip_py(F.coalesce(_c(col).cast("string"), F.lit("None")))
    return F.when(s.isin(NORMALISED_EMPTY), F.lit("")).otherwise(s)


def is_sql_empty_image(col) -> Column:
    return _c(col).isNull() | _c(col).isin(SQL_EMPTY)


# --- URLs and images ---------------------------------------------------------------------------
def last_of_srcset(col) -> Column:
    """P-20: URL of the last non-blank entry of a srcset value."""
    parts = F.filter(F.transform(F.split(_c(col), ","), lambda p: strip_py(p)), lambda p: p != "")
    last = F.try_element_at(parts, F.lit(-1))
    return F.when(F.size(parts) > 0, F.split(last, f"{SPACE}+").getItem(0))


def safe_filename(col) -> Column:
    """P-18: basename of the URL path, percent-decoded, unsafe chars -> '_'; a deterministic
    digest of the URL when nothing is left."""
    u = _c(col)
    path = F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    decoded = F.coalesce(F.try_url_decode(F.replace(base, F.lit("+"), F.lit("%2B"))), base)
    safe = F.regexp_replace(decoded, r"[^0-9A-Za-z\-_.]", "_")
    return F.when(safe == "", F.sha2(u, 256)).otherwise(safe)


def image_object_key(prefix: str, cluster_col, url_col) -> Column:
    """P-19: object key ``{prefix}/cluster_{cid}/{file}``."""
    return F.concat_ws("/", F.lit(prefix), F.concat(F.lit("cluster_"), _c(cluster_col).cast("string")),
                       safe_filename(url_col))


def image_public_url(bucket: str, region: str, key_col) -> Column:
    return F.concat(F.lit(f"https://{bucket}.s3.{region}.amazonaws.com/"), _c(key_col))


def prompt_title_count(col) -> Column:
    """P-23: number of ``N. title: ...`` lines in a prompt."""
    return F.size(F.regexp_extract_all(_c(col), F.lit(f"[0-9]+\\.{SPACE}+title:"), 0))
