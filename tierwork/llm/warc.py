"""Merkle fixity audit of WARC archives.

Pages are packed into WARC response records and records into archives; a record
has an offset and a length in its archive. Offsets are cut into ranges of RANGE
bytes. Trees are built bottom up: the digest of a record, the digest of a range
(its records with their offsets, in order), of FANOUT ranges, and so on up to the
root of an archive; archive roots are joined FANOUT at a time into the root of a
replica. Two replicas are compared from the root down: only children of nodes that
differ are read, and at the bottom only records of ranges that differ. The audit
names every record that is changed, missing, extra or moved.

A node has at most FANOUT children and a range at most RANGE / (shortest record)
records, so no group grows with the data; each level is one aggregate over a
FANOUT-th of the rows below it. Levels are stored in the shared folder, as the
descent reads each of them once.

Defined cases: NULL url or html is told apart from an empty one. Rows that repeat
are records of their own, one after the other. Pages without an id, or many pages
with one id, are spread over archives by digest. Two empty replicas agree; a node
or record that only one replica has differs. Columns other than the named ones are
not part of a record.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import pinned, query, table

RANGE = 1 << 16         # bytes of an offset range
FANOUT = 16
PER_ARCHIVE = 512       # page ids of an archive
SPREAD = 64             # archives that the pages of one id block are spread over at most


def record_text(url: Column, html: Column) -> Column:
    """A WARC response record. The block says whether a field is NULL."""
    field = lambda c: F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-"))
    body = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"), field(html))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), field(url), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"))
    return F.concat(head, F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def pack(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", per_archive: int = PER_ARCHIVE) -> DataFrame:
    """archive, offset, length, digest and the key of each record. Only digests
    and lengths move; records are ordered by key and digest in their archive."""
    record = record_text(F.col(url), F.col(html))
    rows = pages.select(F.col(key).alias("key"), F.sha2(record, 256).alias("digest"), F.octet_length(record).cast("long").alias("length"))
    # equal records are counted before they move, and numbered again afterwards
    runs = rows.groupBy("key", "digest", "length").agg(F.count("*").alias("copies"))
    block = F.coalesce(F.floor(F.col("key") / per_archive).cast("string"), F.lit("none"))
    sizes = runs.withColumn("block", block).groupBy("block").agg(F.count("*").alias("n"))
    spread = F.least(F.lit(SPREAD), F.ceil(F.col("n") / (4 * per_archive)))
    placed = runs.withColumn("block", block).join(sizes, "block").withColumn(
        "archive", F.concat(F.col("block"), F.lit("-"), F.pmod(F.xxhash64("digest"), spread).cast("string")))
    before = Window.partitionBy("archive").orderBy("key", "digest", "length").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("length") * F.col("copies")).over(before), F.lit(0))
    return placed.withColumn("start", start).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).select(
        "archive", (F.col("start") + F.col("copy") * F.col("length")).alias("offset"), "length", "digest", "key")


@dataclass
class Tree:
    """The records with the range they lie in, and the levels of nodes above them
    from the bottom up. A node of ``ranges`` is (archive, node), one of ``archives``
    is (name); ``up`` is the node or name of its parent."""

    records: DataFrame
    ranges: list[DataFrame]
    archives: list[DataFrame]


def _over(children: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One node over a few children: the digest of what they are called and hold."""
    listed = F.transform(F.sort_array(F.collect_list(F.struct(order, "digest"))), lambda c: F.concat_ws(":", c[order].cast("string"), c["digest"]))
    return children.groupBy(*keys).agg(F.sha2(F.array_join(listed, "\n"), 256).alias("digest"))


def build(records: DataFrame, range_bytes: int = RANGE) -> Tree:
    """The tree of one replica's records (archive, offset, length, digest, key)."""
    parent = F.floor(F.col("node") / FANOUT)
    rows = records.withColumn("node", F.floor(F.col("offset") / range_bytes))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("offset", "length", "digest"))),
                         lambda r: F.concat_ws(":", r["offset"].cast("string"), r["length"].cast("string"), r["digest"]))
    level = pinned(rows.groupBy("archive", "node").agg(F.sha2(F.array_join(listed, "\n"), 256).alias("digest")).withColumn("up", parent))
    ranges = [level]
    widest = level.agg(F.coalesce(F.max("node"), F.lit(0))).first()[0]
    while widest > 0:
        widest //= FANOUT
        level = pinned(_over(level, ["archive", "up"], "node").withColumnRenamed("up", "node").withColumn("up", parent))
        ranges.append(level)
    # archives have names, not numbers: they meet under prefixes of a hash, 16 to a digit
    count, digits = level.count(), 0
    while FANOUT ** digits < count:
        digits += 1
    level = level.select(F.sha2("archive", 256).alias("name"), F.sha2(F.concat_ws(":", "archive", "digest"), 256).alias("digest"))
    archives = [pinned(level.withColumn("up", F.substring("name", 1, digits)))]
    for n in range(digits, -1, -1):
        level = _over(archives[-1], ["up"], "name").withColumnRenamed("up", "name")
        archives.append(pinned(level.withColumn("up", F.substring("name", 1, max(n - 1, 0)))))
    return Tree(rows, ranges, archives)


def _differing(one: DataFrame, two: DataFrame, keys: list[str]) -> DataFrame:
    a, b = one.select(*keys, F.col("digest").alias("_a")), two.select(*keys, F.col("digest").alias("_b"))
    return a.join(b, keys, "full").filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*keys)


def _descend(one: list[DataFrame], two: list[DataFrame], keys: list[str]) -> DataFrame:
    """Differing nodes of the lowest level, reached through differing nodes only.
    Trees of another height meet at the lowest level at once."""
    if len(one) != len(two):
        return _differing(one[0], two[0], keys)
    bad = _differing(one[-1], two[-1], keys)
    for a, b in zip(one[-2::-1], two[-2::-1]):
        under = [*keys[:-1], "up"]
        wanted = bad.withColumnRenamed(keys[-1], "up")
        bad = _differing(*[level.join(wanted, under, "left_semi") for level in (a, b)], keys)
    return bad


def audit(one: Tree, two: Tree) -> DataFrame:
    """archive, offset, length, status, digest, other_digest, key of every record that
    differs. ``moved`` is a record found at another offset of its archive."""
    bad = pinned(_descend(one.archives, two.archives, ["name"]))

    def within(level: DataFrame) -> DataFrame:
        return level.withColumn("name", F.sha2("archive", 256)).join(bad, "name", "left_semi").drop("name")

    # below the archives, all but the tops are reached through their parents
    lists = [[*t.ranges[:-1], within(t.ranges[-1])] for t in (one, two)]
    if len(lists[0]) != len(lists[1]):
        lists = [[within(t.ranges[0])] for t in (one, two)]
    nodes = _descend(*lists, ["archive", "node"])
    nodes = pinned(nodes)
    a, b = (t.records.join(nodes, ["archive", "node"], "left_semi").select("archive", "offset", "length", "digest", "key") for t in (one, two))
    other = b.select("archive", "offset", F.col("length").alias("_length"), F.col("digest").alias("_digest"), F.col("key").alias("_key"))
    met = a.join(other, ["archive", "offset"], "full").filter(~(F.col("digest").eqNullSafe(F.col("_digest")) & F.col("length").eqNullSafe(F.col("_length"))))
    status = F.when(F.col("digest").isNull(), "extra").when(F.col("_digest").isNull(), "missing").otherwise("changed")
    found = met.select(
        "archive", "offset", F.coalesce("length", "_length").alias("length"), status.alias("status"), "digest",
        F.col("_digest").alias("other_digest"), F.coalesce("key", "_key").alias("key"))
    # what is gone in one place and there in another has moved
    there = found.filter("other_digest is not null").select("archive", F.col("other_digest").alias("digest"), F.lit(True).alias("_there")).distinct()
    return found.join(there, ["archive", "digest"], "left").withColumn(
        "status", F.when(F.col("_there") & (F.col("status") == "missing"), "moved").otherwise(F.col("status"))).select(found.columns)


@query("""
    WITH records AS (
        SELECT page_id, CAST(page_id // 512 AS BIGINT) AS block, substr(md5(CAST(page_id AS VARCHAR)), 1, 2) AS mark,
               'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: +' || url || chr(13) || chr(10)
               || 'Content-Length: ' || (strlen(html) + 45) AS head,
               chr(13) || chr(10) || chr(13) || chr(10) || 'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
               || chr(13) || chr(10) || '+' AS middle, html, chr(13) || chr(10) || chr(13) || chr(10) AS tail
        FROM pages),
    placed AS (
        SELECT *, strlen(head) + strlen(middle) + strlen(html) + strlen(tail) AS length FROM records),
    offsets AS (
        SELECT *, coalesce(sum(length) OVER (PARTITION BY block ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM placed)
    SELECT page_id, block || '-0' AS archive, CAST(start AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length,
           CASE WHEN mark = '02' THEN 'missing' ELSE 'changed' END AS status,
           sha256(head || middle || html || tail) AS digest,
           CASE WHEN mark = '02' THEN NULL ELSE sha256(head || middle || '~' || substr(html, 2) || tail) END AS other_digest
    FROM offsets WHERE mark IN ('00', '01', '02')""")
def op1_merkle_fixity(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    records = pinned(pack(pages))
    # the replica: the same places, with bytes as they are read back there
    mark = F.substring(F.md5(F.col("page_id").cast("string")), 1, 2)
    flipped = F.when(mark.isin("00", "01"), F.concat(F.lit("~"), F.substring("html", 2, 1 << 30))).otherwise(F.col("html"))
    read_back = pages.select(F.col("page_id").alias("key"), mark.alias("mark"), F.sha2(record_text(F.col("url"), F.col("html")), 256).alias("digest"),
                             F.sha2(record_text(F.col("url"), flipped), 256).alias("now")).filter("mark <> '02'").distinct()
    replica = pinned(records.join(read_back, ["key", "digest"]).select("archive", "offset", "length", F.col("now").alias("digest"), "key"))
    found = audit(build(records), build(replica))
    return found.select(F.col("key").alias("page_id"), "archive", "offset", "length", "status", "digest", "other_digest")
