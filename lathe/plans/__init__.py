"""Query catalogue: importing the ``q_*`` modules registers every key."""

from lathe.plans.base import ORACLE, QUERIES  # noqa: F401


def load_all():
    from lathe.plans import q_rows  # noqa: F401
    for mod in ("q_profile", "q_encode", "q_featuresets", "q_eval", "q_models", "q_io"):
        try:
            __import__(f"lathe.plans.{mod}")
        except ModuleNotFoundError as e:  # modules land one by one while building
            if e.name != f"lathe.plans.{mod}":
                raise
    return QUERIES, ORACLE
