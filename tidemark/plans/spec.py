"""Dataflows described as data: nodes linked by ``inputs``, built lazily into one plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

AGGREGATES = {
    "count": lambda c: F.count(F.lit(1)) if c == "*" else F.count(c),
    "count_distinct": F.count_distinct,
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
}


def _aggregate(node: dict, df: DataFrame) -> DataFrame:
    aggs = [AGGREGATES[a["fn"]](a.get("column", "*")).alias(a["as"]) for a in node["aggregates"]]
    return df.groupBy(*node.get("by", [])).agg(*aggs)


def _sort(node: dict, df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in node["by"]])


def _reshape(node: dict, df: DataFrame) -> DataFrame:
    if node["to"] == "wide":
        agg = AGGREGATES[node.get("fn", "sum")](node["value"])
        return df.groupBy(*node["keep"]).pivot(node["names"], node["values"]).agg(agg)
    return df.unpivot(node["keep"], node["columns"], node["names"], node["value"])


OPERATORS: dict[str, Callable[..., DataFrame]] = {
    "filter": lambda n, df: df.filter(n["condition"]),
    "select": lambda n, df: df.selectExpr(*n["columns"]),
    "derive": lambda n, df: df.withColumns({k: F.expr(v) for k, v in n["columns"].items()}),
    "join": lambda n, a, b: a.join(b, n["on"], n.get("how", "inner")),
    "aggregate": _aggregate,
    "sort": _sort,
    "limit": lambda n, df: df.limit(n["rows"]),
    "distinct": lambda n, df: df.distinct(),
    "union": lambda n, *dfs: _union(dfs),
    "reshape": _reshape,
}


def _union(dfs) -> DataFrame:
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def run_spec(
    spec: list[dict],
    sources: dict[str, DataFrame],
    custom: dict[str, Callable[..., DataFrame]] | None = None,
) -> dict[str, DataFrame]:
    """Build every node of ``spec``; returns the frames by node name.

    A node is ``{"name", "op", "inputs", ...}``. ``source`` takes ``table`` from
    ``sources``, ``sink`` writes its input as parquet to ``path``, ``custom``
    calls the function named ``fn``. Nodes may come in any order.
    """
    custom = custom or {}
    nodes = {n["name"]: n for n in spec}
    if len(nodes) != len(spec):
        raise ValueError("node names must be unique")
    built: dict[str, DataFrame] = {}

    def build(name: str, above: tuple[str, ...] = ()) -> DataFrame:
        if name in built:
            return built[name]
        if name in above:
            raise ValueError(f"nodes form a cycle: {' -> '.join((*above, name))}")
        if name not in nodes:
            raise KeyError(f"unknown node {name!r}")
        node = nodes[name]
        inputs = [build(i, (*above, name)) for i in node.get("inputs", [])]
        op = node["op"]
        if op == "source":
            out = sources[node["table"]]
        elif op == "sink":
            inputs[0].write.mode(node.get("mode", "overwrite")).parquet(node["path"])
            out = inputs[0].sparkSession.read.schema(inputs[0].schema).parquet(node["path"])
        elif op == "custom":
            out = custom[node["fn"]](*inputs)
        elif op in OPERATORS:
            out = OPERATORS[op](node, *inputs)
        else:
            raise ValueError(f"unknown operator {op!r}")
        built[name] = out
        return out

    for n in nodes:
        build(n)
    return built
