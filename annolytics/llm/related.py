"""Problem 3: splits that keep related records together.

Records and the documents they drew on form a bipartite graph. Borůvka rounds contract it: every component chooses its
smallest edge, the chosen edges enter the spanning forest, which is written as a table, and pointer jumping gives every
component its new root. Each round at least halves the components that still have an edge, and drops the edges inside
one. Roots are put into bands of size (powers of two) and dealt systematically within each band.

Scale: every step is a join or an aggregate with a map-side part. A document with a third of all edges, and later the
root of a component that holds a third of all nodes, is a hot key: joins of many rows with one row per node or root
broadcast that side where it is small, and beyond join hot keys apart (join_unique). Tables that a later round replaces
are deleted. Nothing but band totals (at most 64 rows a band), hot keys (below 1,000) and counts comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolytics.operators.joins import join_unique
from annolytics.session import forget, persist_table

SHARES = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
CHUNK = r"^(.+)-c\d+$"


def _roots(parent: DataFrame) -> DataFrame:
    """(node, root) of a forest given as a written table (node, parent), roots pointing to themselves: pointer jumping,
    which halves every path in a round, to the fixed point."""
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = persist_table(join_unique(parent.select("node", "parent"), up, "parent").select("node", F.col("above").alias("parent"), (F.col("parent") != F.col("above")).alias("moved")), "jump")
        moved = jumped.where("moved").limit(1).count()
        forget(parent)
        parent = jumped
        if not moved:
            return parent


def _hashed(e: DataFrame, wide: bool) -> tuple[DataFrame, DataFrame]:
    """(edges with the ids of their ends, names of the ids); wide: ids of 128 bits."""
    make = (lambda c: F.unhex(F.md5(c))) if wide else F.xxhash64
    e = persist_table(e.select(make("a").alias("ca"), make("b").alias("cb"), "a", "b"), "edges")
    end = lambda i, n: F.struct(F.col(i).alias("id"), F.col(n).alias("node"))
    return e, persist_table(e.select(F.explode(F.array(end("ca", "a"), end("cb", "b"))).alias("x")).select("x.*").distinct(), "names")


def spanning_forest(edges: DataFrame, wide: bool = False) -> tuple[DataFrame, DataFrame]:
    """(labels, forest) of the edges (a, b): labels has a row (node, root) for each node, forest the chosen edges (a, b).

    Null ends are dropped, as are loops and repeated edges. Nodes are strings; equal strings are one node, so the two
    sides of a bipartite graph need different prefixes. An empty table gives two empty ones. Components are named by
    64-bit ids; where two nodes share one, as happens among billions, or wide is set, by ids of 128 bits.
    """
    e = edges.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    distinct = persist_table(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "distinct")
    e, names = _hashed(distinct, wide)
    if not wide and names.count() != names.select("id").distinct().count():
        forget(e, names)
        e, names = _hashed(distinct, True)
    labels, forest, parts = names.select("id", F.col("id").alias("root")), None, []
    while True:
        weight = F.struct(F.xxhash64("a", "b").alias("w"), "a", "b")
        ends = e.select(F.explode(F.array(F.struct(F.col("ca").alias("c"), F.col("cb").alias("d")), F.struct(F.col("cb").alias("c"), F.col("ca").alias("d")))).alias("x"), weight.alias("e"))
        best = ends.groupBy("x.c").agg(F.min(F.struct("e", "x.d")).alias("m"))
        best = persist_table(best.select("c", "m.d", F.col("m.e.a").alias("a"), F.col("m.e.b").alias("b")), "best")
        if best.isEmpty():
            break
        parts.append(best)
        chosen = best.select("a", "b").distinct()
        forest = chosen if forest is None else forest.unionAll(chosen)
        # the smallest edge of two components that chose each other closes the only cycle; its smaller end is the root
        back = best.select(F.col("c").alias("d"), F.col("d").alias("back"))
        parent = join_unique(best.select("c", "d"), back, "d", "left")
        root = _roots(persist_table(parent.select(F.col("c").alias("node"), F.when((F.col("back") == F.col("c")) & (F.col("c") < F.col("d")), F.col("c")).otherwise(F.col("d")).alias("parent")), "parent"))
        n = root.count()
        new = persist_table(join_unique(labels, root.select(F.col("node").alias("root"), F.col("parent").alias("r")), "root", "left", n_small=n).select("id", F.coalesce("r", "root").alias("root")), "labels")
        ra, rb = root.select(F.col("node").alias("ca"), F.col("parent").alias("ra")), root.select(F.col("node").alias("cb"), F.col("parent").alias("rb"))
        # of parallel edges between two components only the smallest can be chosen later
        x = join_unique(join_unique(e, ra, "ca", n_small=n), rb, "cb", n_small=n).where("ra <> rb").select(F.least("ra", "rb").alias("ca"), F.greatest("ra", "rb").alias("cb"), "a", "b")
        less = persist_table(x.groupBy("ca", "cb").agg(F.min(F.struct(F.xxhash64("a", "b").alias("w"), "a", "b")).alias("e")).select("ca", "cb", "e.a", "e.b"), "edges")
        forget(e, labels, root)
        e, labels = less, new
    out = labels.join(names, "id").select("node", "root")
    if forest is None:
        forest = names.sparkSession.createDataFrame([], "a string, b string")
    forest = persist_table(forest, "forest")
    forget(e, best, distinct, *parts)
    return out, forest


def source_edges(rows: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, edges record-document) of retrieval rows; keys cleaned.

    A chunk's document is its id without the chunk number, taken within the record's source_domain as qa_records spells
    it; where qa_records hasn't the record, the smallest tidied spelling among the record's own rows. Chunk ids that
    are null, blank or of another form relate nothing, nor do rows without any source_domain.
    """
    from annolytics.sources.tables import clean_key

    r = rows.select(clean_key("record_uuid").alias("record_uuid"), tidy_domain("source_domain").alias("own"), F.regexp_extract(clean_key("chunk_id"), CHUNK, 1).alias("doc")).where("record_uuid IS NOT NULL").distinct()
    known = records.select(clean_key("record_uuid").alias("record_uuid"), tidy_domain("source_domain").alias("domain")).groupBy("record_uuid").agg(F.min("domain").alias("domain"))
    spelled = r.groupBy("record_uuid").agg(F.min("own").alias("own"))
    ids = spelled.join(known, "record_uuid", "left").select("record_uuid", F.coalesce("domain", "own").alias("domain"))
    docs = r.where("doc <> ''").select("record_uuid", "doc").distinct().join(ids.where("domain IS NOT NULL"), "record_uuid")
    return ids.select("record_uuid"), docs.select(F.concat(F.lit("r:"), "record_uuid").alias("a"), F.concat_ws(":", F.lit("d"), "domain", "doc").alias("b"))


def tidy_domain(col):
    """One spelling of a source_domain: lower case, hyphens for underscores and blanks, umlauts written out."""
    from annolytics.sources.tables import clean_key

    t = F.regexp_replace(clean_key(col), r"[\s_]+", "-")
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def related_records(rows: DataFrame, records: DataFrame) -> DataFrame:
    """(record_uuid, group_uuid, size) of every record, alone ones too: group_uuid is the group's smallest record_uuid."""
    ids, edges = source_edges(rows, records)
    labels, _ = spanning_forest(edges)
    own = labels.where("node LIKE 'r:%'").select(F.substring("node", 3, 1 << 20).alias("record_uuid"), "root")
    groups = own.groupBy("root").agg(F.min("record_uuid").alias("group_uuid"), F.count(F.lit(1)).alias("size"))
    groups = persist_table(groups, "groups")
    found = join_unique(own, groups, "root").select("record_uuid", "group_uuid", "size")
    return ids.join(found, "record_uuid", "left").select("record_uuid", F.coalesce("group_uuid", "record_uuid").alias("group_uuid"), F.coalesce("size", F.lit(1)).cast("bigint").alias("size"))


def deal(groups: DataFrame, shares=SHARES, buckets: int = 1024) -> DataFrame:
    """(group_uuid, size, split) for groups (group_uuid, size): bands of size are dealt systematically, largest first.

    Each band's shares are what the larger bands left open, so that one huge group doesn't shift the whole. The groups
    of a band of at most FEW go one by one, largest first, to the split with most room. In other bands a group's place comes from a hash; ranks are counted in `buckets` hash buckets a band, so no band is one task.
    """
    g = groups.withColumn("band", F.floor(F.log2("size")).cast("int")).withColumn("h", F.xxhash64("group_uuid")).withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    stats = g.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight")).orderBy("band", "bucket").collect()  # at most 64 bands x buckets rows, and no more than groups
    bands, starts = {}, []
    for s in stats:
        n, w = bands.get(s.band, (0, 0))
        starts.append((s.band, s.bucket, n))
        bands[s.band] = (n + s.n, w + s.weight)
    few = [b for b, (n, _) in bands.items() if n <= FEW]
    roots = g.where(F.col("band").isin(few)).select("band", "group_uuid", "size").orderBy(F.desc("size"), "group_uuid").collect() if few else []  # at most 64 bands x FEW rows
    total = sum(w for _, w in bands.values())
    left, edges, placed = {k: p * total for k, p in shares}, [], []
    for band in sorted(bands, reverse=True):
        n, w = bands[band]
        open_ = {k: max(v, 0.0) for k, v in left.items()}
        rest = sum(open_.values()) or 1.0
        part = {k: v / rest for k, v in open_.items()}
        at, cuts = 0.0, []
        for k, _ in shares:
            at += part[k]
            cuts.append(at)
        edges.append((band, cuts))
        if n <= FEW:
            for root in (x for x in roots if x.band == band):
                k = max(left, key=left.get)
                placed.append((root.group_uuid, k))
                left[k] -= root.size
        else:
            for k in left:
                left[k] -= part[k] * w
    spark = groups.sparkSession
    starts_df = spark.createDataFrame(starts or [(0, 0, 0)], "band int, bucket int, start long")
    edges_df = spark.createDataFrame(edges or [(0, [1.0])], "band int, cuts array<double>")
    from pyspark.sql import Window

    w = Window.partitionBy("band", "bucket").orderBy("h", "group_uuid")
    g = g.withColumn("r", F.row_number().over(w) - 1).join(starts_df, ["band", "bucket"]).join(edges_df, "band")
    x = (F.col("r") + F.col("start") + 0.5) * GOLDEN
    x = x - F.floor(x)
    split = F.lit(shares[-1][0])
    for i in range(len(shares) - 2, -1, -1):
        split = F.when(x < F.col("cuts")[i], F.lit(shares[i][0])).otherwise(split)
    placed_df = spark.createDataFrame(placed, "group_uuid string, placed string")
    return g.join(F.broadcast(placed_df), "group_uuid", "left").select("group_uuid", "size", F.coalesce("placed", split).alias("split"))


#: Steps of this length along the unit circle stay evenly spread at every count.
GOLDEN = (5**0.5 - 1) / 2
#: Bands of at most so many groups are dealt one by one.
FEW = 64
