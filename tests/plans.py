"""Reading of physical plans."""


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scan_line(df) -> str:
    return next(line for line in plan(df).splitlines() if "FileScan" in line)


def metadata(df) -> str:
    """The formatted plan, with full filter lists."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
