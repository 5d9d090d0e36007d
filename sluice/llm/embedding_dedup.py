"""Embedding near-duplicates by HNSW graphs per shard.

Equal vectors of a label are one class with a representative. A label's
representatives are dealt into shards of bounded size by hash; each shard
gets a graph once, kept as a row of a table in the shared folder. Every
representative queries every shard of its label: the pairs of shards of a
label are a small table to which the graphs are joined, and the task of a
pair searches each side's vectors in the other's graph, so both directions
of a link are seen together. A link is verified by its cosine in double
precision.

A beam that ends above the threshold is widened until it ends below it, so
dense groups are found whole. Each search is audited: for some of the
queries (chosen by hash, ``audit_rows`` per side) all links are computed by
brute force, and the whole search is repeated with twice the beam until the
audited recall reaches ``audit_recall``; a beam as wide as the shard is
exact.

A task returns the number of links of every vector and a spanning forest of
its links, at most one link per vector, never all pairs of a dense group.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise, prepare
from sluice.llm.components import Forest, components
from sluice.llm.hnsw import Graph

SHARD_ROWS = 8192


def _unit(batch) -> np.ndarray:
    """The vectors of an array column as rows of length one, in double precision."""
    flat = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _exact(x: np.ndarray, y: np.ndarray, least: float, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r, c = np.nonzero(x[rows] @ y.T >= least)
    return rows[r], c


def _links(graph: Graph, x: np.ndarray, y: np.ndarray, least: float, beam: int, audit_rows: int, audit_recall: float) -> np.ndarray:
    """Verified (row of x, row of y) links; ``graph`` holds y."""
    slack = least - 1e-4  # the graph is in single precision
    audit = np.linspace(0, len(x) - 1, min(audit_rows, len(x))).astype(int)  # rows are in hash order
    true = np.unique(np.stack(_exact(x, y, least, np.unique(audit)), axis=1), axis=0)
    while True:
        if beam >= len(y):
            found = [np.stack(_exact(x, y, least, np.arange(i, min(i + 512, len(x)))), axis=1) for i in range(0, len(x), 512)]
            return np.concatenate(found)
        q, v = graph.within(x.astype(np.float32), slack, beam)
        ok = np.concatenate([np.einsum("kd,kd->k", x[q[i:i + 100_000]], y[v[i:i + 100_000]]) >= least for i in range(0, max(1, len(q)), 100_000)])
        found = np.stack([q[ok], v[ok]], axis=1)
        # audited links that the search has too
        have = np.isin(true[:, 0] * len(y) + true[:, 1], found[:, 0] * len(y) + found[:, 1]).sum()
        if have >= audit_recall * len(true):
            return found
        beam *= 2


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.93,
                    shard_rows: int = SHARD_ROWS, beam: int = 32, audit_rows: int = 64, audit_recall: float = 0.99) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per row of ``vectors``.

    Only vectors of one label and one dimension are compared. Vectors that
    are null, empty, zero or hold null or non-finite components, and rows
    with a null label or id, link with nothing: n_links 0, their own
    component. Repeated rows are rows; each links with the others.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    valid = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    classes = valid.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = materialise(classes.withColumn("dim", F.size("v")), "vector-classes")
    shards = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    dealt = classes.join(shards, ["label", "dim"]).withColumn("h", F.xxhash64("rep"))
    dealt = dealt.withColumn("shard", F.pmod("h", F.col("shards")).cast("int"))

    label_type = vectors.schema[label_col].dataType.simpleString()

    def build(table):
        table = table.sort_by("h")
        x = _unit(table.column("v").combine_chunks())
        graph = pickle.dumps((Graph(x.astype(np.float32)).layers, x, np.array(table.column("copies").to_pylist(), np.int64)))
        return pa.table({
            "label": table.column("label").slice(0, 1), "dim": table.column("dim").slice(0, 1), "shard": table.column("shard").slice(0, 1),
            "reps": pa.array([table.column("rep").to_pylist()], pa.list_(table.schema.field("rep").type)), "graph": pa.array([graph], pa.binary())})

    rep_type = classes.schema["rep"].dataType.simpleString()
    graphs = dealt.groupBy("label", "dim", "shard").applyInArrow(build, f"label {label_type}, dim int, shard int, reps array<{rep_type}>, graph binary")
    graphs = materialise(graphs, "graphs")

    def side(name: str) -> DataFrame:
        return graphs.select("label", "dim", F.col("shard").alias(name), F.col("reps").alias(f"{name}_reps"), F.col("graph").alias(f"{name}_graph"))

    pairs = shards.select("label", "dim", "shards", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("a"))
    pairs = pairs.select("label", "dim", "a", F.explode(F.sequence(F.col("a"), F.col("shards") - 1)).alias("b"))
    pairs = pairs.repartition("label", "dim", "a", "b").join(side("a"), ["label", "dim", "a"]).join(side("b"), ["label", "dim", "b"])
    arrow_rep = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(rep_type, pa.int64())

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                graph = []
                for s in "ab":
                    g = Graph.__new__(Graph)
                    g.layers, x, copies = pickle.loads(row[f"{s}_graph"])
                    g.vectors = x.astype(np.float32)
                    graph.append((g, x, copies, row[f"{s}_reps"]))
                (ga, xa, ca, ra), (gb, xb, cb, rb) = graph
                same = row["a"] == row["b"]
                found = _links(gb, xa, xb, least, beam, audit_rows, audit_recall)
                if same:
                    found = np.concatenate([found, found[:, ::-1]])
                    found = found[found[:, 0] < found[:, 1]]
                else:
                    found = np.concatenate([found, _links(ga, xb, xa, least, beam, audit_rows, audit_recall)[:, ::-1]])
                found = np.unique(found, axis=0)
                shift = 0 if same else len(ra)
                names, copies = (ra, ca) if same else (ra + rb, np.concatenate([ca, cb]))
                p, q = found[:, 0], found[:, 1] + shift
                count = np.bincount(p, copies[q], len(names)) + np.bincount(q, copies[p], len(names))
                forest = Forest(len(names))
                forest.link(p, q)
                some = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([
                    pa.array([names[k] for k in some] + [names[u] for u, _ in forest.links], arrow_rep),
                    pa.array([None] * len(some) + [names[v] for _, v in forest.links], arrow_rep),
                    pa.array(np.concatenate([count[some].astype(np.int64), np.zeros(len(forest.links), np.int64)]))], ["u", "v", "n"])

    found = materialise(pairs.select("a", "b", "a_reps", "a_graph", "b_reps", "b_graph").mapInArrow(search, f"u {rep_type}, v {rep_type}, n long"), "vector-links")
    counts = found.where("v IS NULL").groupBy("u").agg(F.sum("n").alias("n"))
    linked = components(found.where("v IS NOT NULL").select("u", "v"))
    named = classes.join(counts, F.col("rep") == F.col("u"), "left").join(linked, F.col("rep") == F.col("node"), "left")
    named = named.select(
        F.col("label").alias("_label"), F.col("v").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("_links"),
        F.coalesce("component", "rep").alias("_component"))
    named = materialise(named, "vector-components")
    whole = F.col("vec_id").isNotNull() & F.col("label").eqNullSafe(F.col("_label")) & F.col("v").eqNullSafe(F.col("_v"))
    out = rows.join(named, whole, "left")
    return out.select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_component", "vec_id").alias("component_id"),
        F.coalesce("_component", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"))
