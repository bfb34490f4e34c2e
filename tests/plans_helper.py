"""The plan a frame ran by."""


def plan_of(frame) -> str:
    """The executed physical plan as text; runs the query so adaptive steps are settled."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()
