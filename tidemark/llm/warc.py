"""WARC archives: written and read by Spark's text source, so any file system will do.

Writing: a record ends with two line breaks, which is the line separator given to the text
writer. Equal payloads are stored once; later ones become revisit records.

Reading: files are split at the version line that opens a record, so a large file is read by many
tasks. A version line may also stand inside a payload, hence what a task sees are candidates only.
Each gives the offset of its successor from its Content-Length. Inside a split these pointers are
followed locally; between splits pointer jumping doubles the steps each round. Only records
that the chain from the file's first byte reaches are kept. Payloads that hold version lines
themselves are put together from their parts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed values of the format.
VERSION, BREAK, END = "WARC/1.1\r\n", "\r\n", "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:page:"
#: Bytes of a file in which a payload's parts are looked up together.
CELL = 1 << 20


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: each 40 of its 160 bits are 8 digits."""
    hexes = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(hexes, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """One record per row of ``pages`` in files below ``path``.

    Of rows with equal payloads of at least ``least_bytes`` bytes, those with the smallest id are
    responses and the others revisit it; smaller payloads are all responses. A null payload is
    empty. Rows that repeat the smallest id with that payload are all responses; rows with a null
    id refer to the smallest id if there is one, and are responses if not. Blanks and other odd
    characters of addresses are escaped; a null address is left out. Other columns are not looked at.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload")
    ).select("*", F.octet_length("payload").alias("n"), base32_sha1(F.col("payload").cast("binary")).alias("digest"))
    shared = rows.filter(F.col("n") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    # Stored, so that Spark knows its size when it plans the join with the payloads.
    shared = stored(shared.filter("rows > 1 and first is not null").drop("rows"), "warc-shared")
    rows = rows.join(shared, "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("n") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("first"))
    named = lambda c: F.concat(F.lit(f"<{NAME}"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace(F.col("url"), "[\r\n]+", "%0D%0A"), "[\\x00-\\x20]", "%20")
    head_bytes = len(HTTP_HEAD) + len(END)
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))
    record = F.concat(
        F.lit(VERSION),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", named(F.col("id"))),
        field("WARC-Date", F.lit(date)),
        F.coalesce(field("WARC-Target-URI", url), F.lit("")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("X-Payload-Length", F.col("n").cast("string")),
        F.when(revisit, F.concat(field("WARC-Refers-To", named(F.col("first"))), field("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(""),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), (F.lit(head_bytes) + F.when(revisit, 0).otherwise(F.col("n"))).cast("string"), F.lit(END),
        F.lit(HTTP_HEAD + END),
        F.when(revisit, "").otherwise(F.col("payload")),
    )
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """What follows each version line, in order within ``file, block``; the first of a file comes before any."""
    return spark.read.option("lineSep", VERSION).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _parsed(chunks: DataFrame, payload: bool) -> DataFrame:
    """Fields of the candidate that a chunk would be; ``size`` is null where it has no valid header."""
    value = F.col("value")
    head = F.substring_index(value, END, 1)
    field = lambda name: F.nullif(F.regexp_extract(F.col("head"), f"(?im)^{name}:[ \\t]*([^\\r\\n]*)", 1), F.lit(""))
    number = lambda c: F.regexp_extract(c, f"^<{NAME}(-?\\d+)>$", 1).try_cast("bigint")
    out = chunks.withColumn("head", head).withColumn("bytes", F.octet_length(value).cast("bigint"))
    out = out.withColumn("opens", (F.octet_length("head") + len(END)).cast("bigint")).withColumn("content", field("Content-Length").try_cast("bigint"))
    valid = (F.col("opens") <= F.col("bytes")) & (F.col("content") >= 0)
    http = F.coalesce(field("Content-Type"), F.lit("")).startswith("application/http")
    starts = F.when(http, F.octet_length(F.substring_index(value, END, 2)) + len(END)).otherwise(F.col("opens")).cast("bigint")
    out = out.withColumn("starts", F.least(starts, F.col("opens") + F.col("content")))
    length = (F.col("opens") + F.col("content") - F.col("starts")).cast("int")
    body = F.substring(value.cast("binary"), (F.col("starts") + 1).cast("int"), length)
    here = valid & (F.col("opens") + F.col("content") <= F.col("bytes"))
    columns = [
        F.when(valid, F.col("opens") + F.col("content")).alias("size"), here.alias("whole"), "starts",
        field("WARC-Type").alias("record_type"), field("WARC-Record-ID").alias("record_id"), field("WARC-Target-URI").alias("url"),
        number(field("WARC-Record-ID")).alias("page_id"), number(field("WARC-Refers-To")).alias("refers_to"),
        F.regexp_extract(field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("stated_digest"),
        field("X-Payload-Length").try_cast("bigint").alias("stated_bytes"),
        F.when(here, length.cast("bigint")).alias("body_bytes"), F.when(here, base32_sha1(body)).alias("body_digest"),
    ]
    return out.select("file", "block", "bytes", *columns, *([F.when(here, body).alias("payload")] if payload else []))


def _followed(sizes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the candidates of one split: the next one in the split (or -1), and where the chain leaves it (or -1)."""
    n = len(starts)
    wanted = np.where(sizes >= 0, starts + len(VERSION) + sizes + len(END), -1)
    at = np.minimum(np.searchsorted(starts, wanted), max(n - 1, 0))
    following = np.where((wanted >= 0) & (starts[at] == wanted), at, -1)
    leaves = np.where(following < 0, wanted, -1)
    # Jump to the end of each local chain.
    end, jump = np.arange(n), following.copy()
    while (jump >= 0).any():
        go = jump >= 0
        end[go] = jump[go]
        end = np.where(go, end[end], end)
        jump = following[end]
    return following, leaves[end]


def read_archive(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records below ``path``: ``file, offset, record_type, record_id, page_id, url, refers_to,
    payload_bytes, payload_digest`` and, if asked for, ``payload`` (null for revisits).

    Length and digest of a response are taken from its bytes, those of a revisit from its fields.
    A file whose first bytes are no record gives nothing; reading a file ends at a record without
    a valid length. Empty files give no records. ``page_id`` is null where the record's id is no
    number.
    """
    parsed = _parsed(_chunks(spark, path), payload)
    fields = [c for c in parsed.columns if c not in ("file", "block", "bytes", "size")]

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Offsets relative to the split's first chunk, and the local chains."""
        held: list[pd.DataFrame] = []
        at: list = [None, None]

        def flush() -> Iterator[pd.DataFrame]:
            if held:
                rows = pd.concat(held, ignore_index=True)
                ends = (rows["bytes"].to_numpy(np.int64) + len(VERSION)).cumsum()
                starts = np.concatenate(([0], ends[:-1])) - len(VERSION)
                sizes = rows["size"].fillna(-1).to_numpy(np.int64)
                if at[1] == 0:
                    sizes[0] = -1  # what comes before the first version line
                following, leaves = _followed(sizes, starts)
                yield pd.DataFrame(
                    {"file": rows["file"], "block": rows["block"], "rank": np.arange(len(rows)), "start": starts, "bytes": rows["bytes"],
                     "size": sizes, "following": following, "leaves": leaves} | {c: rows[c] for c in fields}
                )
                held.clear()

        for batch in batches:
            cuts = np.flatnonzero((batch["file"].ne(batch["file"].shift())) | (batch["block"].ne(batch["block"].shift())))
            for low, high in zip(cuts, [*cuts[1:], len(batch)]):
                part = batch.iloc[low:high]
                key = [part["file"].iloc[0], int(part["block"].iloc[0])]
                if key != at:
                    yield from flush()
                    at[:] = key
                held.append(part)
        yield from flush()

    kinds = dict(parsed.dtypes)
    schema = "file string, block bigint, rank bigint, start bigint, bytes bigint, size bigint, following bigint, leaves bigint, "
    texts = [c for c in fields if kinds[c] == "bigint"]
    safe = parsed.select("file", "block", "bytes", "size", *[F.col(c).cast("string").alias(c) if c in texts else F.col(c) for c in fields])
    seen = stored(safe.mapInPandas(follow, schema + ", ".join(f"{c} {'string' if c in texts else kinds[c]}" for c in fields)), "warc-seen")
    seen = seen.select(*seen.columns[:8], *[F.col(c).cast("bigint").alias(c) if c in texts else F.col(c) for c in fields])

    # Where each split's first chunk starts: the bytes of the splits ahead of it. A file has one row per split.
    sizes = seen.groupBy("file", "block").agg(F.sum(F.col("bytes") + len(VERSION)).alias("n"))
    bases = stored(
        sizes.select("file", "block", (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("base")), "warc-bases"
    )
    placed = seen.join(bases, ["file", "block"]).withColumn("offset", F.col("base") + F.col("start"))
    jumps = stored(
        placed.filter("size >= 0 and leaves >= 0").select("file", "offset", (F.col("base") + F.col("leaves")).alias("to")), "warc-jumps"
    )
    # A jump counts where a candidate of another split stands at its end.
    jumps = stored(jumps.join(placed.filter("size >= 0").select("file", F.col("offset").alias("to")), ["file", "to"]), "warc-jumps")
    reached = seen.select("file", F.lit(0).cast("bigint").alias("offset")).distinct()
    while not jumps.isEmpty():
        more = reached.join(jumps, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        reached = stored(reached.union(more).distinct(), "warc-reached")
        beyond = jumps.select("file", F.col("offset").alias("to"), F.col("to").alias("further"))
        jumps = stored(jumps.join(beyond, ["file", "to"]).select("file", "offset", F.col("further").alias("to")), "warc-jumps")

    def mark(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        following, good = rows["following"].to_numpy(), np.zeros(len(rows), bool)
        for k in np.flatnonzero(rows["entry"].to_numpy()):
            while k >= 0 and not good[k]:
                good[k] = True
                k = following[k]
        return rows.loc[good, ["file", "block", "rank"]]

    entries = placed.filter("size >= 0").join(reached, ["file", "offset"], "left_semi").select("file", "block", "rank", F.lit(True).alias("entry"))
    links = seen.select("file", "block", "rank", "following").join(entries.hint("merge"), ["file", "block", "rank"], "left").fillna(False, ["entry"])
    # A group is one split of a file.
    good = stored(links.groupBy("file", "block").applyInPandas(mark, "file string, block bigint, rank bigint"), "warc-good")
    # Not broadcast: names of files repeat, so the stored size says little about that in memory.
    records = placed.join(good.hint("merge"), ["file", "block", "rank"])
    parts = records.filter("not whole").select("file", "offset", "starts", "size")
    body = [F.col("body_bytes"), F.col("body_digest"), *([F.col("payload")] if payload else [])]
    if not parts.isEmpty():
        records = records.join(_joined(spark, path, bases, parts), ["file", "offset"], "left")
        body = [F.coalesce(c, F.col(f"far_{n}")) for c, n in zip(body, ("bytes", "digest", "payload"))]
    revisit = F.col("record_type") == "revisit"
    return records.select(
        "file", "offset", "record_type", "record_id", "page_id", "url", "refers_to",
        F.when(revisit, F.col("stated_bytes")).otherwise(body[0]).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(body[1]).alias("payload_digest"),
        *([F.when(~revisit, body[2]).alias("payload")] if payload else []),
    )


def _joined(spark: SparkSession, path: str, bases: DataFrame, records: DataFrame) -> DataFrame:
    """``file, offset, far_bytes, far_digest, far_payload`` of records whose payload holds version lines."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, done = None, 0
        for batch in batches:
            starts = []
            for file, block, value in zip(batch["file"], batch["block"], batch["value"]):
                if (file, block) != key:
                    key, done = (file, block), 0
                starts.append(done)
                done += len(value) + len(VERSION)
            yield batch.assign(start=starts)

    chunks = _chunks(spark, path).withColumn("value", F.col("value").cast("binary"))
    chunks = chunks.mapInPandas(number, "file string, block bigint, value binary, start bigint").join(bases, ["file", "block"])
    chunks = chunks.select("file", (F.col("base") + F.col("start")).alias("at"), "value").withColumn("cell", F.expr(f"at div {CELL}"))
    ends = F.col("offset") + len(VERSION) + F.col("size")
    wanted = records.withColumn("end", ends).withColumn("cell", F.explode(F.sequence(F.expr(f"offset div {CELL}"), F.expr(f"end div {CELL}"))))
    # A part counts when the version line before it lies in the record.
    inside = (F.col("at") > F.col("offset")) & (F.col("at") <= F.col("end"))
    met = chunks.join(wanted.withColumnRenamed("file", "of"), (F.col("file") == F.col("of")) & (chunks["cell"] == wanted["cell"]) & inside)
    # The parts of one record: as much as its payload.
    whole = met.groupBy("file", "offset", "starts", "size").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))

    @F.pandas_udf("binary")
    def join(parts: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([VERSION.encode().join(p["value"] for p in x)[a:b] for x, a, b in zip(parts, starts, sizes)])

    whole = whole.select("file", "offset", join("parts", "starts", "size").alias("far_payload"))
    return whole.select("file", "offset", F.octet_length("far_payload").cast("bigint").alias("far_bytes"), base32_sha1(F.col("far_payload")).alias("far_digest"), "far_payload")
