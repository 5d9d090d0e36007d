"""Read SQL metrics of an executed plan (in-process, no UI)."""


def nodes(df):
    """(node name, metrics dict) of every node of the executed plan, pre-order."""
    out = []

    def walk(node):
        info = {}
        ms = node.metrics()
        it = ms.keysIterator()
        while it.hasNext():
            k = it.next()
            info[k] = ms.get(k).get().value()
        out.append((node.nodeName(), info))
        for attr in ("executedPlan", "plan"):
            try:
                inner = getattr(node, attr)()
            except Exception:
                continue
            if inner is not None:
                walk(inner)
                return
        ch = node.children()
        for i in range(ch.size()):
            walk(ch.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def shuffle_records(df):
    return [m["shuffleRecordsWritten"] for n, m in nodes(df) if n == "Exchange" and "shuffleRecordsWritten" in m]
