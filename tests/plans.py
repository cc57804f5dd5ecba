"""What the plan of a DataFrame that has been collected says about its scans."""


def nodes(df):
    """Every node of the plan that ran, below stages too."""

    def walk(plan):
        yield plan
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            yield from walk(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            yield from walk(plan.plan())
        else:
            children = plan.children()
            for i in range(children.size()):
                yield from walk(children.apply(i))

    return list(walk(df._jdf.queryExecution().executedPlan()))


def names(df):
    return [n.getClass().getSimpleName() for n in nodes(df)]


def scans(df):
    return [n for n in nodes(df) if n.getClass().getSimpleName() == "FileSourceScanExec"]


def rows_scanned(df):
    return sum(n.metrics().get("numOutputRows").get().value() for n in scans(df))


def rows_exchanged(df):
    """Rows that went through the exchanges of shuffles, an exchange that is reused once."""
    found = [n for n in nodes(df) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    return [n.metrics().get("shuffleRecordsWritten").get().value() for n in found]
