"""newsweave: a PySpark library that turns a flow of short articles into maintained topics.

Every stage is a DataFrame -> DataFrame function. Nothing is collected to the driver
except scalar convergence checks inside iterative operators.
"""

from newsweave.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
