"""Runs the operators over the shared test tables and states the expected results in SQL."""


def load_all() -> None:
    """Import every module that registers queries."""
    from conformance import q_builds, q_quality, q_relational, q_reports, q_scalars, q_segments, q_sources  # noqa: F401
