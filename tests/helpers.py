"""Plain-Python answers to compare Spark's with, and small conveniences."""

from collections import Counter


def bag(df, *columns):
    """The frame's rows as a multiset; NaN equals itself, -0.0 equals 0.0."""
    names = columns or df.columns
    return Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def _plain(value):
    if isinstance(value, float):
        return "NaN" if value != value else value + 0.0
    return value


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    """Runs the frame and returns the plan AQE ended up with."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def scan_metric(df, name):
    """Runs the frame and adds up a metric of its Parquet scans."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    nodes, total = [execution.executedPlan()], 0
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        else:
            if node.nodeName().startswith("Scan parquet"):
                total += node.metrics().apply(name).value()
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
    return total


def brute_change_set(old, new, n_keys):
    """All pairs, row by row. Rows are tuples that start with their key."""
    def key(r):
        return r[:n_keys]

    def match(a, b):
        return key(a) == key(b) and None not in key(a)

    out = [r + ("I",) for r in new if not any(match(r, o) for o in old)]
    out += [o + ("D",) for o in old if not any(match(o, r) for r in new)]
    out += [r + ("U",) for o in old for r in new if match(o, r) and tuple(map(_plain, o)) != tuple(map(_plain, r))]
    return Counter(tuple(map(_plain, r)) for r in out)


def brute_replay(log, target, n_keys):
    """Day after day, on a list. Rows are key, values, op, day."""
    state = []
    for day in sorted({r[-1] for r in log if r[-1] <= target}):
        today = [r for r in log if r[-1] == day]
        gone = {r[:n_keys] for r in today if r[-2] in ("D", "I", "U") and None not in r[:n_keys]}
        state = [r for r in state if r[:n_keys] not in gone]
        state += [r[:-2] for r in today if r[-2] in ("I", "U")]
    return Counter(state)
