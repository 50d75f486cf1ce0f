"""Connected components by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebind.session import settle


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (else the smaller) neighbours of each node on the least."""
    around = _both(edges)
    if not large:
        around = around.filter("b < a")
    least = around.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("u"), F.least("a", "m").alias("m")
    )
    met = around.join(least, around["a"] == least["u"])
    if large:
        rows = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        rows = met.select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
        )).alias("e")).select("e.*")
    return rows.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of the links (a, b): the least id that can be
    reached.  Each round is written to the shared folder; their number grows with
    the logarithm of the longest path.  Without links the result is empty.
    """
    now = settle(edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).filter("a <> b").distinct())
    seen = None
    while True:
        stamp = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if stamp == seen or not stamp[0]:
            break
        seen = stamp
        now = settle(_star(_star(now, True), False))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
