"""Looking at physical plans."""


def physical_plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()
