"""DuckDB SQL for the correctness oracle: the same derivations and operators written as
plain SQL over the pre-registered TESTDATA views. Pieces are composed from CTE strings.
"""

from __future__ import annotations

# --- derived inputs (mirror newsweave.sources.testdata) ----------------------------------------
RAW_ARTICLES = """
raw_articles AS (
  SELECT doc_id AS pos,
         split_part(text, chr(10), 1) AS title,
         source AS press,
         text AS news_summary,
         CASE WHEN doc_id % 20 = 19 THEN strftime(ts, '%Y-%m-%d %H:%M')
              ELSE strftime(ts, '%Y.%m.%d.') || ' ' ||
                   CASE WHEN hour(ts) < 12 THEN '오전' ELSE '오후' END || ' ' ||
                   CAST(CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE hour(ts) % 12 END AS VARCHAR) || ':' ||
                   strftime(ts, '%M') END AS publish_date,
         CASE WHEN doc_id % 20 = 19 THEN 'unknown' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS datetime_sort,
         'https://news.example.com/' || md5(text) AS news_link
  FROM (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id * 37 AS BIGINT)) AS ts FROM documents)
)"""

PLANTED = """
planted AS (
  SELECT e.vec_id AS pos,
         CASE WHEN e.vec_id % 10 = 9
              THEN list_transform(e.embedding, lambda x: CAST(x AS DOUBLE))
              ELSE list_transform(e.embedding, lambda x, i: CAST(b.embedding[i] AS DOUBLE) + CAST(0.4 AS DOUBLE) * CAST(x AS DOUBLE))
         END AS embedding,
         CASE WHEN e.vec_id % 10 = 9 THEN -1 ELSE CAST(e.vec_id % 20 AS INTEGER) END AS label,
         (e.vec_id % 7 = 0) AS is_new
  FROM embeddings e LEFT JOIN embeddings b ON b.vec_id = e.vec_id % 20
),
baseline_vec AS (SELECT pos, embedding, label AS tfidf_cluster_id FROM planted WHERE NOT is_new),
new_vec AS (SELECT pos, embedding FROM planted WHERE is_new)"""

CENTROIDS = """
cent_elems AS (
  SELECT tfidf_cluster_id AS cluster_id, unnest(embedding) AS x,
         unnest(generate_series(0, len(embedding) - 1)) AS dim
  FROM baseline_vec WHERE tfidf_cluster_id <> -1
),
cent_dims AS (SELECT cluster_id, dim, avg(x) AS v FROM cent_elems GROUP BY ALL),
cent_meta AS (
  SELECT tfidf_cluster_id AS cluster_id, min(pos) AS first_pos, count(*) AS n
  FROM baseline_vec WHERE tfidf_cluster_id <> -1 GROUP BY ALL
),
cents AS (
  SELECT m.cluster_id, m.first_pos, m.n, list(d.v ORDER BY d.dim) AS centroid
  FROM cent_meta m JOIN cent_dims d USING (cluster_id) GROUP BY ALL
)"""

ASSIGN = """
sims AS (
  SELECT n.pos, c.cluster_id, c.first_pos,
         CASE WHEN list_dot_product(n.embedding, n.embedding) = 0
                OR list_dot_product(c.centroid, c.centroid) = 0 THEN 0.0
              ELSE list_dot_product(n.embedding, c.centroid)
                   / (sqrt(list_dot_product(n.embedding, n.embedding)) * sqrt(list_dot_product(c.centroid, c.centroid)))
         END AS sim
  FROM new_vec n, cents c
),
assigned AS (
  SELECT pos, sim AS best_sim,
         CASE WHEN sim >= 0.85 THEN cluster_id ELSE -1 END AS assigned_tfidf_cluster
  FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY sim DESC, first_pos) AS rn FROM sims) WHERE rn = 1
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


def centroids_sql() -> str:
    return with_(PLANTED, CENTROIDS) + """
SELECT m.cluster_id, m.first_pos, m.n, CAST(d.dim AS INTEGER) AS dim, round(d.v, 6) AS value
FROM cent_meta m JOIN cent_dims d USING (cluster_id)"""


def assign_centroid_sql() -> str:
    return with_(PLANTED, CENTROIDS, ASSIGN) + """
SELECT pos, assigned_tfidf_cluster, round(best_sim, 6) AS best_sim FROM assigned"""


def cluster_sizes_sql() -> str:
    return with_(PLANTED, CENTROIDS, ASSIGN) + """
SELECT cluster_id, count(*) AS n_articles, sum(CASE WHEN is_new THEN 1 ELSE 0 END) AS n_new
FROM (SELECT tfidf_cluster_id AS cluster_id, false AS is_new FROM baseline_vec
      UNION ALL SELECT assigned_tfidf_cluster, true FROM assigned)
WHERE cluster_id <> -1
GROUP BY cluster_id HAVING count(*) >= 2"""


# --- scalar rules in DuckDB (RE2: no look-behind, no (?d); '.' already stops only at \n) ----------
from newsweave.functions import text as TX  # noqa: E402

SP = TX.SPACE
W = TX.WORD


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_strip(e: str) -> str:
    return f"regexp_replace({e}, {_q(f'^{SP}+|{SP}+$')}, '', 'g')"


def sql_hanja(e: str) -> str:
    for k, v in TX.HANJA_TO_HANGUL.items():
        if len(k) == 1:
            e = f"replace({e}, {_q(k)}, {_q(v)})"
    return e


def sql_clean(e: str) -> str:
    t = e
    t = (f"regexp_replace({t}, {_q(f'(^|[^{TX.WORD_CHARS}]){W}[{TX.WORD_CHARS}.-]* ?@ ?[{TX.WORD_CHARS}.-]+[.]{W}+')}, "
         f"'\\1', 'g')")
    t = f"regexp_replace({t}, {_q(f'@{W}+')}, '', 'g')"
    t = f"regexp_replace({t}, {_q(f'https?://{TX.NON_SPACE}+|url[.]kr/{TX.NON_SPACE}+')}, '', 'g')"
    for sym in TX.REMOVED_SYMBOLS:
        t = f"replace({t}, {_q(sym)}, '')"
    t = f"regexp_replace({t}, {_q(r'[[].*?[]]')}, '', 'g')"
    t = f"regexp_replace({t}, {_q(r'[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]')}, '', 'g')"
    t = f"regexp_replace({t}, {_q('※.*')}, '', 'g')"
    for label, sep in TX.META_RULES:
        t = f"regexp_replace({t}, {_q(f'{label}{SP}*{sep}{SP}*.*')}, '', 'g')"
    t = f"regexp_replace({t}, {_q(f'{TX.KAKAO_LABEL}{SP}*:{SP}*@{W}+')}, '', 'g')"
    t = f"regexp_replace({t}, {_q('ⓒ[^.\\n]*[.\\n]?')}, '', 'g')"
    t = f"regexp_replace({t}, {_q('▲[^.\\n]*[.\\n]?')}, '', 'g')"
    t = f"replace({t}, {_q(chr(92) + chr(39))}, {_q(chr(39))})"
    t = f"regexp_replace({t}, {_q(f'{SP}+')}, ' ', 'g')"
    return sql_strip(t)


def sql_korean_dt(e: str) -> str:
    s = sql_strip(e)
    pat = _q(f"^([0-9]{{4}})[.]([0-9]{{2}})[.]([0-9]{{2}})[.]{SP}*({TX.AM}|{TX.PM}){SP}*([0-9]+):([0-9]+)")

    def g(i):
        return f"regexp_extract({s}, {pat}, {i})"

    hour = f"TRY_CAST({g(5)} AS INTEGER)"
    hour = (f"(CASE WHEN {g(4)} = {_q(TX.AM)} AND {hour} = 12 THEN 0 "
            f"WHEN {g(4)} = {_q(TX.PM)} AND {hour} <> 12 THEN {hour} + 12 ELSE {hour} END)")
    return (f"(CASE WHEN regexp_matches({s}, {pat}) THEN try(make_timestamp("
            f"TRY_CAST({g(1)} AS BIGINT), TRY_CAST({g(2)} AS BIGINT), TRY_CAST({g(3)} AS BIGINT), "
            f"{hour}, TRY_CAST({g(6)} AS BIGINT), 0.0)) END)")


def sql_tokens(e: str) -> str:
    return f"regexp_extract_all(lower({e}), {_q(f'({W}{{2,}})')}, 1)"


def sql_fill(e: str) -> str:
    return f"coalesce(CAST({e} AS VARCHAR), '')"


PREPROCESSED = f"""
pre_a AS (
  SELECT pos, press, news_summary, news_link, publish_date AS datetime,
         {sql_clean(sql_hanja(sql_fill('title')))} AS title,
         {sql_clean(sql_hanja(sql_fill('news_summary')))} AS summary
  FROM raw_articles
),
articles AS (
  SELECT pos, title, press, news_summary, summary, datetime,
         {sql_korean_dt('datetime')} AS publish_date,
         {sql_tokens(sql_strip("title || ' ' || summary"))} AS konlpy_nouns,
         news_link
  FROM pre_a
)"""


def clean_text_sql() -> str:
    return f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents"


def remove_brackets_sql() -> str:
    return with_(RAW_ARTICLES) + f"""
SELECT pos, {sql_strip(f"regexp_replace(title, {_q(r'[[].*?[]]')}, '', 'g')")} AS title FROM raw_articles"""


def korean_datetime_sql() -> str:
    return with_(RAW_ARTICLES) + f"SELECT pos, {sql_korean_dt('publish_date')} AS publish_ts FROM raw_articles"


def preprocess_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED) + """
SELECT pos, title, summary, press, datetime, publish_date, array_to_string(konlpy_nouns, ' ') AS nouns_text,
       len(konlpy_nouns) AS n_nouns, news_link
FROM articles"""


def tokens_sql() -> str:
    return f"""SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct,
  array_to_string(t, ' ') AS tokens_text FROM (SELECT doc_id, {sql_tokens('text')} AS t FROM documents)"""


def parse_vector_sql() -> str:
    return """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS dim, round(CAST(v AS DOUBLE), 6) AS value
FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(CAST(x AS VARCHAR) AS FLOAT)) AS p FROM embeddings),
     unnest(p) WITH ORDINALITY AS u(v, i)"""


def parse_tokens_sql() -> str:
    return f"""SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens_text
FROM (SELECT doc_id, {sql_tokens('text')} AS t FROM documents)"""


def nonempty_summary_sql() -> str:
    return with_(RAW_ARTICLES) + f"""
SELECT pos, news_link FROM raw_articles
WHERE news_summary IS NOT NULL AND length({sql_strip('news_summary')}) > 0"""


def parse_sort_ts_sql() -> str:
    return with_(RAW_ARTICLES) + "SELECT pos, TRY_CAST(datetime_sort AS TIMESTAMP) AS sort_ts FROM raw_articles"


# --- TF-IDF / neighbours / DBSCAN in SQL --------------------------------------------------------
from newsweave.operators import tfidf as _TF  # noqa: E402


def tfidf_ctes(src: str, tokens: str = "konlpy_nouns", prefix: str = "", group: str | None = None) -> str:
    """CTEs {prefix}vec(pos, gram, tf, df, w) for the rows of CTE ``src``."""
    stop = ", ".join(_q(s) for s in _TF.STOP_WORDS)
    p = prefix
    gsel = f"{group} AS g, " if group else ""
    gcol = "g, " if group else ""
    gpre = "CAST(g AS VARCHAR) || chr(1) || " if group else ""
    ggrp = f"GROUP BY {group}" if group else ""
    njoin = f"JOIN {prefix}ndocs nd ON nd.g = tf.g" if group else f", {prefix}ndocs"
    return f"""
{p}toks AS (
  SELECT pos, {gsel}list_filter(regexp_extract_all(lower(array_to_string({tokens}, ' ')), {_q(f'({W}{{2,}})')}, 1),
                          lambda x: NOT list_contains([{stop}], x)) AS t
  FROM {src}
),
{p}idx AS (SELECT pos, {gcol}t, unnest(generate_series(1, len(t))) AS i FROM {p}toks),
{p}grams AS (
  SELECT pos, {gcol}{gpre}array_to_string(list_slice(t, i, i + n - 1), ' ') AS gram
  FROM {p}idx, (VALUES (1), (2), (3), (4), (5)) ns(n) WHERE i + n - 1 <= len(t)
),
{p}tf AS (SELECT pos, {gcol}gram, count(*) AS tf FROM {p}grams GROUP BY ALL),
{p}dfq AS (SELECT gram, count(*) AS df FROM {p}tf GROUP BY gram HAVING count(*) >= 2),
{p}ndocs AS (SELECT {gsel}count(*) AS n FROM {src} {ggrp}),
{p}w0 AS (SELECT tf.pos, tf.gram, tf.tf, d.df, tf.tf * (ln((1 + n) / (1 + d.df)) + 1) AS w
          FROM {p}tf tf JOIN {p}dfq d USING (gram) {njoin}),
{p}vec AS (SELECT pos, gram, tf, df, w / sqrt(sum(w * w) OVER (PARTITION BY pos)) AS w FROM {p}w0)"""


def neighbour_ctes(vec: str, eps: float, prefix: str = "") -> str:
    """{prefix}pairs(a, b, sim): brute-force sparse dot products, a < b, 1 - sim <= eps."""
    p = prefix
    return f"""
{p}pairs AS (
  SELECT a, b, sim FROM (
    SELECT x.pos AS a, y.pos AS b, sum(x.w * y.w) AS sim
    FROM {vec} x JOIN {vec} y ON x.gram = y.gram AND x.pos < y.pos GROUP BY ALL)
  WHERE 1 - sim <= {eps}
)"""


def dbscan_ctes(points: str, pairs: str, min_samples: int, prefix: str = "") -> str:
    """{prefix}labels(pos, label) from neighbour pairs of non-zero rows (self counts)."""
    p = prefix
    return f"""
{p}nb AS (SELECT a AS x, b AS y FROM {pairs} UNION ALL SELECT b, a FROM {pairs}),
{p}cnt AS (
  SELECT pos, 1 + coalesce((SELECT count(*) FROM {p}nb WHERE {p}nb.x = pos), 0) AS c
  FROM {points} WHERE nonzero
),
{p}core AS (SELECT pos FROM {p}cnt WHERE c >= {min_samples}),
{p}cedge AS (SELECT x, y FROM {p}nb WHERE x IN (SELECT pos FROM {p}core) AND y IN (SELECT pos FROM {p}core)),
{p}reach AS (
  WITH RECURSIVE r(node, src) AS (
    SELECT pos, pos FROM {p}core
    UNION
    SELECT e.y, r.src FROM r JOIN {p}cedge e ON e.x = r.node
  )
  SELECT node, min(src) AS root FROM r GROUP BY node
),
{p}num AS (SELECT root, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS label FROM (SELECT DISTINCT root FROM {p}reach)),
{p}corelab AS (SELECT r.node AS pos, n.label FROM {p}reach r JOIN {p}num n USING (root)),
{p}borderlab AS (
  SELECT e.x AS pos, min(c.label) AS label FROM {p}nb e JOIN {p}corelab c ON c.pos = e.y
  WHERE e.x NOT IN (SELECT pos FROM {p}core) GROUP BY e.x
),
{p}labels AS (
  SELECT pt.pos, CAST(coalesce(cl.label, bl.label, -1) AS INTEGER) AS label
  FROM {points} pt LEFT JOIN {p}corelab cl USING (pos) LEFT JOIN {p}borderlab bl USING (pos)
)"""


def tfidf_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, tfidf_ctes("articles")) + \
        "SELECT pos, gram, tf, df, round(w, 6) AS w FROM vec"


def similar_pairs_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, tfidf_ctes("articles"), neighbour_ctes("vec", 0.6)) + \
        "SELECT a, b, round(sim, 4) AS sim FROM pairs"


def dbscan_labels_sql() -> str:
    pts = "pts AS (SELECT a.pos, a.pos IN (SELECT pos FROM vec) AS nonzero FROM articles a)"
    return with_(RAW_ARTICLES, PREPROCESSED, tfidf_ctes("articles"), neighbour_ctes("vec", 0.6), pts,
                 dbscan_ctes("pts", "pairs", 2)) + "SELECT pos, label FROM labels"


def dbscan_embeddings_sql() -> str:
    dense = """
dpairs AS (
  SELECT a, b FROM (
    SELECT x.pos AS a, y.pos AS b,
           list_dot_product(x.embedding, y.embedding) / (sqrt(list_dot_product(x.embedding, x.embedding)) * sqrt(list_dot_product(y.embedding, y.embedding))) AS sim
    FROM planted x JOIN planted y ON x.pos < y.pos)
  WHERE 1 - sim <= 0.25
),
pts AS (SELECT pos, list_dot_product(embedding, embedding) > 0 AS nonzero FROM planted)"""
    return with_(PLANTED, dense, dbscan_ctes("pts", "dpairs", 3)) + "SELECT pos, label FROM labels"


# --- batch cluster cycle over the articles (documents-derived) -------------------------------
def _emb_ctes(src: str) -> str:
    return f"""
emb_tok AS (SELECT pos, unnest({sql_tokens("coalesce(CAST(news_summary AS VARCHAR), '')")}) AS t FROM {src}),
emb AS (
  SELECT pos, CAST((CAST('0x' || substr(md5(t), 1, 8) AS BIGINT)) % 64 AS INTEGER) AS dim,
         sum(CASE WHEN substr(md5(t), 9, 1) < '8' THEN 1.0 ELSE -1.0 END) AS val
  FROM emb_tok GROUP BY ALL
)"""


def cycle_ctes(db_max_id: int = 0) -> str:
    return ",".join(c.strip("\n") for c in [
        RAW_ARTICLES, PREPROCESSED,
        "cyc_base AS (SELECT * FROM articles WHERE pos % 7 <> 0)",
        "cyc_new AS (SELECT * FROM articles WHERE pos % 7 = 0)",
        tfidf_ctes("cyc_base", prefix="b_"), neighbour_ctes("b_vec", 0.6, prefix="b_"),
        "b_pts AS (SELECT pos, pos IN (SELECT pos FROM b_vec) AS nonzero FROM cyc_base)",
        dbscan_ctes("b_pts", "b_pairs", 3, prefix="b_"),
        _emb_ctes("articles"),
        """
c_meta AS (SELECT label AS cluster_id, min(pos) AS first_pos, count(*) AS n FROM b_labels WHERE label <> -1 GROUP BY ALL),
c_dims AS (SELECT l.label AS cluster_id, e.dim, sum(e.val) AS s FROM b_labels l JOIN emb e USING (pos) WHERE l.label <> -1 GROUP BY ALL),
c_vec AS (SELECT d.cluster_id, d.dim, d.s / m.n AS v, m.first_pos FROM c_dims d JOIN c_meta m USING (cluster_id)),
c_norm AS (SELECT cluster_id, sqrt(sum(v * v)) AS nrm FROM c_vec GROUP BY ALL),
e_norm AS (SELECT pos, sqrt(sum(val * val)) AS nrm FROM emb GROUP BY ALL),
n_sims AS (
  SELECT n.pos, c.cluster_id, c.first_pos, sum(e.val * c.v) / (any_value(en.nrm) * any_value(cn.nrm)) AS sim
  FROM cyc_new n JOIN emb e USING (pos) JOIN c_vec c ON c.dim = e.dim
       JOIN e_norm en ON en.pos = n.pos JOIN c_norm cn ON cn.cluster_id = c.cluster_id
  WHERE en.nrm > 0 AND cn.nrm > 0 GROUP BY n.pos, c.cluster_id, c.first_pos
),
n_assigned AS (
  SELECT n.pos, coalesce(b.cluster_id, -1) AS assigned
  FROM cyc_new n LEFT JOIN (
    SELECT pos, cluster_id FROM (
      SELECT *, row_number() OVER (PARTITION BY pos ORDER BY sim DESC, first_pos) AS rn FROM n_sims WHERE sim >= 0.85)
    WHERE rn = 1) b USING (pos)
),
pool AS (
  SELECT a.pos AS pos, a.konlpy_nouns FROM cyc_base a JOIN b_labels l USING (pos) WHERE l.label = -1
  UNION ALL
  SELECT a.pos + 1099511627776 AS pos, a.konlpy_nouns FROM cyc_new a JOIN n_assigned s USING (pos) WHERE s.assigned = -1
)""",
        tfidf_ctes("pool", prefix="t_"), neighbour_ctes("t_vec", 0.6, prefix="t_"),
        "t_pts AS (SELECT pos, pos IN (SELECT pos FROM t_vec) AS nonzero FROM pool)",
        dbscan_ctes("t_pts", "t_pairs", 2, prefix="t_"),
        f"""
t_start AS (
  SELECT coalesce(max(c) + 1, 0) AS start FROM (
    SELECT label AS c FROM b_labels WHERE label <> -1 UNION ALL SELECT assigned FROM n_assigned WHERE assigned <> -1)
),
merged AS (
  SELECT false AS is_new, l.pos, CASE WHEN t.label IS NOT NULL AND t.label <> -1 THEN t.label + s.start ELSE l.label END AS tfidf_cluster_id,
         (t.label IS NOT NULL AND t.label <> -1) AS is_third
  FROM b_labels l LEFT JOIN t_labels t ON t.pos = l.pos, t_start s
  UNION ALL
  SELECT true, a.pos, CASE WHEN t.label IS NOT NULL AND t.label <> -1 THEN t.label + s.start ELSE a.assigned END,
         (t.label IS NOT NULL AND t.label <> -1)
  FROM n_assigned a LEFT JOIN t_labels t ON t.pos = a.pos + 1099511627776, t_start s
),
seed AS (
  SELECT greatest(coalesce(max(tfidf_cluster_id), {db_max_id}), {db_max_id}) + 1 AS start
  FROM merged WHERE NOT is_new AND NOT is_third AND tfidf_cluster_id <> -1
),
grp_a AS (SELECT DISTINCT tfidf_cluster_id AS l FROM merged WHERE is_new AND NOT is_third AND tfidf_cluster_id <> -1),
grp_b AS (SELECT DISTINCT tfidf_cluster_id AS l FROM merged WHERE is_new AND is_third AND tfidf_cluster_id <> -1),
id_map AS (
  SELECT l, max_by(cid, g) AS cid FROM (
    SELECT l, seed.start + row_number() OVER (ORDER BY l) - 1 AS cid, 0 AS g FROM grp_a, seed
    UNION ALL
    SELECT l, seed.start + (SELECT count(*) FROM grp_a) + row_number() OVER (ORDER BY l) - 1, 1 FROM grp_b, seed)
  GROUP BY l
),
clustered AS (
  SELECT m.*, CAST(coalesce(i.cid, -1) AS INTEGER) AS cluster_id
  FROM merged m LEFT JOIN id_map i ON i.l = m.tfidf_cluster_id
)"""])


def embed_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _emb_ctes("articles")) + \
        "SELECT pos, dim, val FROM emb WHERE val <> 0"


def baseline_labels_sql() -> str:
    return "WITH " + cycle_ctes() + "\nSELECT pos, label AS tfidf_cluster_id FROM b_labels"


def third_stage_sql() -> str:
    return "WITH " + cycle_ctes() + "\nSELECT is_new, pos, CAST(tfidf_cluster_id AS INTEGER) AS tfidf_cluster_id, is_third FROM merged"


def assign_cluster_ids_sql() -> str:
    return "WITH " + cycle_ctes() + "\nSELECT is_new, pos, CAST(tfidf_cluster_id AS INTEGER) AS tfidf_cluster_id, cluster_id FROM clustered"


def target_clusters_sql() -> str:
    return "WITH " + cycle_ctes() + """,
pre AS (SELECT DISTINCT tfidf_cluster_id AS l FROM clustered WHERE NOT is_new AND NOT is_third AND tfidf_cluster_id <> -1),
third AS (SELECT DISTINCT tfidf_cluster_id AS l FROM clustered WHERE is_third AND tfidf_cluster_id <> -1),
joined AS (SELECT DISTINCT tfidf_cluster_id AS l FROM clustered WHERE is_new AND NOT is_third AND tfidf_cluster_id <> -1
           AND tfidf_cluster_id IN (SELECT l FROM pre)),
labs AS (SELECT l FROM third WHERE l NOT IN (SELECT l FROM pre) UNION SELECT l FROM joined)
SELECT DISTINCT cluster_id FROM clustered WHERE tfidf_cluster_id IN (SELECT l FROM labs) AND cluster_id <> -1"""


# --- summaries and load -------------------------------------------------------------------------
from newsweave.plans import summaries as _SM  # noqa: E402


def sql_fmt(template: str, **exprs) -> str:
    import re
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        parts.append(_q(template[pos:m.start()].replace("{{", "{").replace("}}", "}")))
        parts.append(f"coalesce(CAST({exprs[m.group(1)]} AS VARCHAR), 'nan')")
        pos = m.end()
    parts.append(_q(template[pos:].replace("{{", "{").replace("}}", "}")))
    return "(" + " || ".join(parts) + ")"


def _summary_ctes(p: str, where: str) -> str:
    layout = sql_fmt(_SM.ARTICLE_LAYOUT, n="pos + 1", title="title", news_summary="news_summary", press="press")
    prompt = sql_fmt(_SM.PROMPT_TEMPLATE, articles="body", cluster_id="cluster_id", summary_time="'2025-07-11 09:00'")
    return f"""
{p}art AS (
  SELECT *, TRY_CAST(regexp_extract(press, '[0-9]+') AS INTEGER) AS cluster_id,
         (pos % 7 = 0) AS is_new, false AS is_third
  FROM articles WHERE {where}
),
{p}big AS (SELECT cluster_id, count(*) AS n FROM {p}art WHERE cluster_id IS NOT NULL AND cluster_id <> -1 GROUP BY ALL HAVING count(*) >= 2),
{p}prompts AS (
  SELECT cluster_id, n, {prompt} AS prompt FROM (
    SELECT a.cluster_id, b.n, string_agg({layout}, chr(10) || chr(10) ORDER BY a.pos) AS body
    FROM {p}art a JOIN {p}big b USING (cluster_id) GROUP BY ALL)
),
{p}parsed AS (
  SELECT cluster_id,
         CASE cluster_id % 5 WHEN 3 THEN 'skipped' WHEN 2 THEN 'failed' ELSE 'ok' END AS status,
         CASE WHEN cluster_id % 5 IN (2, 3) THEN '' ELSE 'topic ' || CAST(cluster_id AS VARCHAR) END AS topic_name,
         CASE WHEN cluster_id % 5 IN (2, 3) THEN '' ELSE 'summary of ' || CAST(n AS VARCHAR) || ' articles' END AS ai_summary,
         '2025-07-11 09:00' AS summary_time,
         CASE WHEN cluster_id % 5 IN (2, 3) THEN 0 ELSE n END AS n_titles
  FROM {p}big
),
{p}ok AS (SELECT cluster_id FROM {p}parsed WHERE status = 'ok'),
{p}tl AS (
  SELECT cluster_id, title, CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY pos DESC) - 1 AS INTEGER) AS title_pos
  FROM {p}art WHERE cluster_id IN (SELECT cluster_id FROM {p}ok)
),
{p}firsts AS (SELECT cluster_id, title, min(pos) AS fpos FROM {p}art WHERE cluster_id IS NOT NULL AND cluster_id <> -1 GROUP BY ALL),
{p}matched AS (
  SELECT t.cluster_id, t.title_pos, a.pos, a.title, a.news_link, a.press,
         strftime(a.publish_date, '%Y-%m-%d %H:%M:%S') AS publish_date,
         coalesce(a.news_summary, '') AS news_summary, CAST(a.is_new AS INTEGER) AS is_new,
         CAST(a.is_third AS INTEGER) AS is_third
  FROM {p}tl t JOIN {p}firsts f USING (cluster_id, title) JOIN {p}art a ON a.pos = f.fpos
)"""


def _load_ctes(stored: str = " WHERE cluster_id % 3 <> 0") -> str:
    """``stored``: the condition on topics that the previous cycle had seen."""
    return ",".join(c.strip("\n") for c in [
        RAW_ARTICLES, PREPROCESSED, _summary_ctes("p_", "pos % 7 <> 0"), _summary_ctes("c_", "true"), f"""
stored_topic AS (SELECT cluster_id AS id FROM p_ok{stored}),
stored_news AS (
  SELECT DISTINCT ON (cluster_id, title, news_link) cluster_id AS topic_id, title, news_link, press, publish_date,
         news_summary, is_new, is_third
  FROM p_matched{stored}
),
new_topics AS (SELECT p.cluster_id AS id, p.topic_name, p.ai_summary, p.summary_time FROM c_parsed p
               WHERE p.status = 'ok' AND p.cluster_id NOT IN (SELECT id FROM stored_topic)),
cur AS (
  SELECT DISTINCT ON (cluster_id, title, news_link) cluster_id AS topic_id, title, news_link, press, publish_date,
         news_summary, is_new, is_third
  FROM c_matched
),
ins_news AS (
  SELECT c.* FROM cur c
  WHERE c.topic_id IN (SELECT id FROM stored_topic UNION SELECT id FROM new_topics)
    AND NOT EXISTS (SELECT 1 FROM stored_news s WHERE s.topic_id IS NOT DISTINCT FROM c.topic_id
                    AND s.title IS NOT DISTINCT FROM c.title AND s.news_link IS NOT DISTINCT FROM c.news_link)
),
all_news AS (SELECT * FROM stored_news UNION ALL SELECT * FROM ins_news)"""])


def build_prompts_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true")) + "SELECT cluster_id, n, prompt FROM c_prompts"


def prompt_titles_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true")) + f"""
SELECT cluster_id, len(regexp_extract_all(prompt, {_q(f'[0-9]+[.]{SP}+title:')})) AS n_titles FROM c_prompts"""


def parse_response_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true")) + \
        "SELECT cluster_id, status, topic_name, ai_summary, summary_time, n_titles FROM c_parsed"


def match_titles_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true")) + \
        "SELECT cluster_id, title_pos, pos, title, news_link FROM c_matched"


def summaries_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true")) + \
        "SELECT cluster_id, summary_time, topic_name, ai_summary, '' AS image_url FROM c_parsed WHERE status = 'ok'"


def failed_responses_sql() -> str:
    # the failing answers are JSON text with trailing words; compare the ids and the marker
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true")) + """
SELECT CAST(cluster_id AS BIGINT) AS cluster_id, true AS has_trailing_words FROM c_parsed WHERE status = 'failed'"""


def new_topics_sql() -> str:
    return "WITH " + _load_ctes() + "\nSELECT id, topic_name, ai_summary, summary_time FROM new_topics"


def insert_news_sql() -> str:
    return "WITH " + _load_ctes() + "\nSELECT * FROM ins_news"


def refresh_is_new_sql() -> str:
    ts = ("coalesce(try_strptime(publish_date, '%Y-%m-%d %H:%M:%S'), try_strptime(publish_date, '%Y-%m-%d %H:%M'))")
    return "WITH " + _load_ctes() + f""",
refd AS (SELECT max({ts}) AS r FROM all_news)
SELECT topic_id, title, news_link, CASE WHEN {ts} >= r - INTERVAL 24 HOUR THEN 1 ELSE 0 END AS is_new
FROM all_news, refd"""


def news_count_sql() -> str:
    return "WITH " + _load_ctes() + "\nSELECT count(*) AS n_news FROM all_news"


# --- links, ingest bookkeeping, pages, images --------------------------------------------------
LISTING = """
listing AS (
  SELECT page_id, CAST(i - 1 AS INTEGER) AS idx, news_link, page_id * 1048576 + (i - 1) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1) AS l FROM pages),
       unnest(l) WITH ORDINALITY AS u(news_link, i)
),
marker AS (SELECT arg_min(news_link, pos) AS last_seen_link FROM listing WHERE page_id = (SELECT max(page_id) FROM listing)),
stop AS (SELECT min(pos) AS s FROM listing WHERE news_link IN (SELECT last_seen_link FROM marker)),
new_links AS (
  SELECT pos, news_link FROM (
    SELECT news_link, min(pos) AS pos FROM listing, stop
    WHERE (stop.s IS NULL OR pos < stop.s) AND news_link IS NOT NULL AND news_link <> ''
    GROUP BY news_link)
)"""


def extract_links_sql() -> str:
    return with_(LISTING) + "SELECT page_id, idx, news_link FROM listing"


def last_seen_sql() -> str:
    return with_(LISTING) + "SELECT arg_min(news_link, pos) AS last_seen_link FROM listing"


def new_links_sql() -> str:
    return with_(LISTING) + "SELECT pos // 1048576 AS page_id, (pos % 1048576)::INTEGER AS idx, news_link FROM new_links"


def merge_links_sql() -> str:
    return with_(LISTING) + """
SELECT news_link, batch, pos // 1048576 AS page_id, (pos % 1048576)::INTEGER AS idx FROM (
  SELECT news_link, 0 AS batch, pos FROM new_links
  UNION ALL
  SELECT news_link, 1, pos FROM (SELECT news_link, min(pos) AS pos FROM listing GROUP BY news_link)
  WHERE news_link NOT IN (SELECT news_link FROM new_links))"""


def gated_links_sql() -> str:
    return with_(LISTING) + """
SELECT count(*) AS n_links, count(*) >= 3 AS proceed FROM (
  SELECT news_link FROM new_links
  UNION ALL
  SELECT news_link FROM (SELECT DISTINCT news_link FROM listing)
  WHERE news_link NOT IN (SELECT news_link FROM new_links))"""


def dedup_keep_first_sql() -> str:
    return with_(RAW_ARTICLES) + "SELECT min(pos) AS pos, news_link FROM raw_articles GROUP BY news_link"


def accumulate_sql() -> str:
    return with_(RAW_ARTICLES) + """
SELECT arg_min(pos, (b, pos)) AS pos, news_link, min(b) AS batch
FROM (SELECT pos, news_link, CASE WHEN pos % 7 = 0 THEN 0 ELSE 1 END AS b FROM raw_articles)
GROUP BY news_link"""


def skip_first_sql() -> str:
    return with_(RAW_ARTICLES) + "SELECT pos FROM raw_articles ORDER BY pos OFFSET 5"


def sort_articles_sql() -> str:
    return with_(RAW_ARTICLES) + f"""
SELECT pos, news_link FROM raw_articles
WHERE news_summary IS NOT NULL AND length({sql_strip('news_summary')}) > 0
  AND TRY_CAST(datetime_sort AS TIMESTAMP) IS NOT NULL"""


def page_fields_sql() -> str:
    def decoded(e: str) -> str:
        for ref, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
            e = f"replace({e}, '{ref}', '{c}')"
        return e
    raw = sql_strip("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")
    t = sql_strip(f"regexp_replace({decoded(raw)}, '[[].*?[]]', '', 'g')")
    h1 = decoded(sql_strip("regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"))
    return f"SELECT page_id, {t} AS title, {h1} AS h1 FROM pages WHERE contains(html, '<title>')"


def extract_pages_sql() -> str:
    day = "lpad((1 + page_id % 28)::VARCHAR, 2, '0')"
    return f"""SELECT 'News ' || page_id || ' &more' AS title, 'Press ' || (page_id % 13) || ' <K>' AS press,
  CASE WHEN page_id % 8 = 4 THEN '' ELSE 'Part ' || page_id || ' line two' END AS news_summary,
  '2024.01.' || {day} || '. 오전 10:00' AS publish_date, '2024-01-' || {day} || ' 10:00:00' AS datetime_sort,
  url AS news_link, page_id AS pos FROM pages WHERE page_id % 8 NOT IN (5, 6, 7)"""


def listing_articles_sql() -> str:
    return """SELECT page_id, 0 AS idx, url || '&n=' || page_id AS news_link, 'Title' || page_id AS text FROM pages
UNION ALL SELECT page_id, 1, '/x/' || page_id, 'Second' FROM pages"""


def page_image_sql() -> str:
    return """SELECT page_id, CASE page_id % 9 WHEN 0 THEN 'https://img.example.com/' || page_id || '.jpg'
  WHEN 1 THEN 'https://img.example.com/' || page_id || '.png?w=1&h=2' WHEN 2 THEN 'https://og.example.com/' || page_id
  WHEN 3 THEN 'https://tw.example.com/' || page_id WHEN 4 THEN 'https://a.example.com/' || page_id || '.jpg'
  WHEN 7 THEN 'https://o.example.com/' || page_id WHEN 8 THEN 'https://tw.example.com/' || page_id END AS image_url FROM pages"""


def image_object_sql() -> str:
    path = "regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
    base = f"regexp_extract({path}, '([^/]*)$', 1)"
    dec = f"url_decode(replace({base}, '+', '%2B'))"
    safe = f"regexp_replace({dec}, '[^0-9A-Za-z_.-]', '_', 'g')"
    return f"""SELECT page_id, file_name, 'news-images/cluster_' || CAST(page_id AS VARCHAR) || '/' || file_name AS object_key
FROM (SELECT page_id, CASE WHEN {safe} = '' THEN sha256(url) ELSE {safe} END AS file_name FROM pages)"""


# --- remaining relational items -------------------------------------------------------------------
def cluster_count_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true")) + \
        "SELECT count(DISTINCT cluster_id) AS n_clusters FROM c_art WHERE cluster_id <> -1"


def quality_metrics_sql() -> str:
    return with_(RAW_ARTICLES) + f"""
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE news_summary IS NOT NULL AND length({sql_strip('news_summary')}) > 0) AS n_with_summary,
       count(*) FILTER (WHERE TRY_CAST(datetime_sort AS TIMESTAMP) IS NOT NULL) AS n_sort_parsed,
       count(*) FILTER (WHERE {sql_korean_dt('publish_date')} IS NOT NULL) AS n_date_parsed
FROM raw_articles"""


def preprocess_alt_sql() -> str:
    return with_(RAW_ARTICLES) + f"""
SELECT pos, {sql_clean('title')} AS title, {sql_hanja(sql_fill('news_summary'))} AS news_summary,
       {sql_korean_dt('publish_date')} AS publish_date,
       len({sql_tokens(sql_hanja(sql_fill('news_summary')))}) AS n_nouns
FROM raw_articles"""


def retry_prompts_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true")) + \
        "SELECT cluster_id, n FROM c_big WHERE cluster_id IN (SELECT cluster_id FROM c_parsed WHERE status = 'failed')"


_IMG = """
imgs AS (SELECT news_link, 'https://img.example.com/' || md5(news_link) || '.jpg' AS image_url FROM c_art WHERE pos % 3 = 0),
chosen AS (
  SELECT m.cluster_id, arg_min(i.image_url, m.pos) AS url
  FROM c_matched m JOIN imgs i USING (news_link) WHERE i.image_url IS NOT NULL GROUP BY m.cluster_id
),
filled AS (SELECT p.cluster_id, coalesce(c.url, '') AS image_url FROM c_parsed p LEFT JOIN chosen c USING (cluster_id)
           WHERE p.status = 'ok')"""


def cluster_image_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true"), _IMG) + \
        "SELECT cluster_id, url FROM chosen WHERE cluster_id IN (SELECT cluster_id FROM c_ok)"


def fill_image_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true"), _IMG) + "SELECT cluster_id, image_url FROM filled"


def image_completeness_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true"), _IMG) + """
SELECT count(*) AS n, count(*) FILTER (WHERE image_url = '') AS n_empty,
       (count(*) FILTER (WHERE image_url = '') = 0 AND count(*) > 0) AS complete FROM filled"""


def update_topic_images_sql() -> str:
    return "WITH " + _load_ctes("") + "," + _IMG.strip("\n") + """
SELECT t.id, CASE WHEN f.image_url IS NOT NULL AND f.image_url <> '' THEN f.image_url ELSE '' END AS image_url
FROM stored_topic t LEFT JOIN filled f ON f.cluster_id = t.id"""


def news_with_image_sql() -> str:
    return "WITH " + _load_ctes("") + "," + _IMG.strip("\n") + """
SELECT n.topic_id, n.title, n.news_link, coalesce(f.image_url, '') AS image_url
FROM ins_news n LEFT JOIN filled f ON f.cluster_id = n.topic_id"""


def second_stage_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true"), """
s_all AS (SELECT pos, coalesce(cluster_id, -1) AS ec, konlpy_nouns FROM c_art),
s_big AS (SELECT ec FROM s_all WHERE ec <> -1 GROUP BY ec HAVING count(*) >= 50),
s_rows AS (SELECT * FROM s_all WHERE ec IN (SELECT ec FROM s_big))""",
                 tfidf_ctes("s_rows", prefix="s_", group="ec"), neighbour_ctes("s_vec", 0.6, prefix="s_"),
                 "s_pts AS (SELECT pos, pos IN (SELECT pos FROM s_vec) AS nonzero FROM s_rows)",
                 dbscan_ctes("s_pts", "s_pairs", 3, prefix="s_"), """
s_sub AS (SELECT l.pos, r.ec, l.label FROM s_labels l JOIN s_rows r USING (pos) WHERE l.label <> -1),
s_first AS (SELECT ec, label, min(pos) AS f FROM s_sub GROUP BY ALL),
s_start AS (SELECT coalesce(max(ec) + 1, 0) AS st FROM s_all WHERE ec <> -1),
s_ids AS (SELECT ec, label, CAST(st + row_number() OVER (ORDER BY ec, f) - 1 AS INTEGER) AS nid FROM s_first, s_start)""") + """
SELECT a.pos, a.ec AS embedding_cluster_id, CAST(coalesce(i.nid, a.ec) AS INTEGER) AS tfidf_cluster_id,
       i.nid IS NOT NULL AS second
FROM s_all a LEFT JOIN s_sub s USING (pos) LEFT JOIN s_ids i ON i.ec = s.ec AND i.label = s.label"""


# --- id bookkeeping over the planted-vector clusters -------------------------------------------------
def noise_union_sql() -> str:
    return with_(PLANTED, CENTROIDS, ASSIGN) + """
SELECT 0 AS side, pos FROM baseline_vec WHERE tfidf_cluster_id = -1
UNION ALL SELECT 1, pos FROM assigned WHERE assigned_tfidf_cluster = -1"""


def id_seed_sql() -> str:
    return with_(PLANTED) + """
SELECT greatest(coalesce(max(tfidf_cluster_id), 10), 10) AS seed_max FROM baseline_vec WHERE tfidf_cluster_id <> -1"""


def cluster_id_range_sql() -> str:
    return with_(PLANTED, CENTROIDS, ASSIGN) + """,
seed AS (SELECT greatest(coalesce(max(tfidf_cluster_id), 10), 10) + 1 AS st FROM baseline_vec WHERE tfidf_cluster_id <> -1),
grp_a AS (SELECT DISTINCT assigned_tfidf_cluster AS l FROM assigned WHERE assigned_tfidf_cluster <> -1),
ids AS (SELECT l, st + row_number() OVER (ORDER BY l) - 1 AS cid FROM grp_a, seed),
allrows AS (SELECT tfidf_cluster_id AS l FROM baseline_vec UNION ALL SELECT assigned_tfidf_cluster FROM assigned)
SELECT CAST(min(cid) AS INTEGER) AS min_id, CAST(max(cid) AS INTEGER) AS max_id, count(*) AS n_rows
FROM allrows JOIN ids USING (l)"""


def complete_summary_sql() -> str:
    return with_(RAW_ARTICLES, PREPROCESSED, _summary_ctes("c_", "true")) + """
SELECT i.cluster_id, p.topic_name, CASE WHEN p.cluster_id IS NULL THEN NULL ELSE '' END AS image_url
FROM (SELECT DISTINCT cluster_id FROM c_art WHERE cluster_id IS NOT NULL) i
LEFT JOIN (SELECT * FROM c_parsed WHERE status = 'ok') p USING (cluster_id)"""


def target_rows_sql() -> str:
    return "WITH " + cycle_ctes() + """,
pre AS (SELECT DISTINCT tfidf_cluster_id AS l FROM clustered WHERE NOT is_new AND NOT is_third AND tfidf_cluster_id <> -1),
third AS (SELECT DISTINCT tfidf_cluster_id AS l FROM clustered WHERE is_third AND tfidf_cluster_id <> -1),
joined AS (SELECT DISTINCT tfidf_cluster_id AS l FROM clustered WHERE is_new AND NOT is_third AND tfidf_cluster_id <> -1
           AND tfidf_cluster_id IN (SELECT l FROM pre)),
labs AS (SELECT l FROM third WHERE l NOT IN (SELECT l FROM pre) UNION SELECT l FROM joined),
tg AS (SELECT DISTINCT cluster_id FROM clustered WHERE tfidf_cluster_id IN (SELECT l FROM labs) AND cluster_id <> -1)
SELECT is_new, pos, cluster_id FROM clustered WHERE cluster_id IN (SELECT cluster_id FROM tg)"""
