"""Secret scan with corpus-wide ownership frequency, in DataFrame functions alone.

Every text is searched for assigned secrets, access keys, hex strings and opaque tokens.
Hashes of the values found are counted over the whole corpus by distinct repositories and
distinct owners: a value that many owners share, or that stands in very many repositories, is a
copied example, one that a single owner has in few places looks like a live credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from suarakit.functions.binding import let
from suarakit.llm.common import column, text_key, written

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
OPAQUE = "[A-Za-z0-9+/_-]{20,}"
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "opaque")

_PLACE = "array<struct<start:int,end:int,hit:string>>"
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


#: Matches whose places are added up at once. Appending to an array copies it, so arrays stay short.
_BLOCK = 128


def _placed(parts: Column, upto: Column) -> Column:
    """Places of the matches in some parts of a text that begin at ``upto``."""

    def step(acc: Column, part: Column) -> Column:
        start = acc["upto"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        place = F.array(F.struct(start.alias("start"), end.alias("end"), part["hit"].alias("hit")))
        return F.struct(
            F.coalesce(end, start).alias("upto"),
            F.when(part["hit"].isNull(), acc["found"]).otherwise(F.concat(acc["found"], place)).alias("found"),
        )

    empty = F.struct(upto.alias("upto"), F.array().cast(_PLACE).alias("found"))
    return F.aggregate(parts, empty, step, lambda acc: acc["found"])


def _by_blocks(parts: Column) -> Column:
    """Places of many matches: lengths are summed by block, and each block is placed on its own."""
    block = lambda i: F.slice(parts, i * _BLOCK + 1, F.lit(_BLOCK))
    numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _BLOCK).cast("int"))

    def width(i: Column) -> Column:
        return F.aggregate(block(i), F.lit(0), lambda n, part: n + F.length(part["gap"]) + F.coalesce(F.length(part["hit"]), F.lit(0)))

    def add(acc: Column, n: Column) -> Column:
        return F.struct((acc["upto"] + n).alias("upto"), F.concat(acc["starts"], F.array(acc["upto"])).alias("starts"))

    none = F.struct(F.lit(0).alias("upto"), F.array().cast("array<int>").alias("starts"))
    return let(
        F.aggregate(F.transform(numbers, width), none, add, lambda acc: acc["starts"]),
        lambda starts: F.flatten(F.transform(numbers, lambda i: _placed(block(i), F.get(starts, i)))),
    )


def located(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches with their places in code points, end exclusive.

    The gaps between matches and the matches alternate, so running lengths give the places.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit")
    )
    return let(parts, lambda p: F.when(F.size(p) <= _BLOCK, _placed(p, F.lit(0))).otherwise(_by_blocks(p)))


def _spans(text: Column, kind: str, pattern: str, guard: Column, value=lambda hit: hit, keep=lambda value: F.lit(True)) -> Column:
    """Spans of one kind; texts that fail the cheap ``guard`` are not searched."""

    def span(place: Column) -> Column:
        return F.struct(
            place["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            place["end"].alias("end"),
            F.lit(kind).alias("kind"),
            value(place["hit"]).alias("value"),
        )

    found = F.filter(F.transform(located(text, pattern), span), lambda s: keep(s["value"]))
    return F.when(guard, found.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    """Assigned secrets of 12 characters or more, access keys of 18, hex strings of 16."""
    return {
        "assign": _spans(
            text,
            "assign",
            ASSIGN,
            text.rlike(ASSIGN),
            lambda hit: F.regexp_extract(hit, ASSIGN, 2),
            lambda value: F.length(value) >= 12,
        ),
        "access": _spans(text, "access", ACCESS, F.contains(text, F.lit("AKIA"))),
        "hex": _spans(text, "hex", HEX, text.rlike(HEX)),
    }


def opaque_spans(text: Column) -> Column:
    """Runs of 20 or more token characters that have both letters and digits."""
    return _spans(
        text, "opaque", OPAQUE, text.rlike(OPAQUE), keep=lambda value: value.rlike("[A-Za-z]") & value.rlike("[0-9]")
    )


def candidates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", owner_column: str = "source"
) -> DataFrame:
    """id, key, owner, base and opaque (arrays of spans) for every row; null texts have none."""
    text = column(docs, text_column).cast("string")
    keyed = docs.select(
        column(docs, id_column).alias("id"),
        text_key(text).alias("key"),
        column(docs, owner_column).cast("string").alias("owner"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    return keyed.select(
        "id",
        "key",
        "owner",
        F.array_sort(F.concat(*base_spans(F.col("text")).values())).alias("base"),
        opaque_spans(F.col("text")).alias("opaque"),
    )


def ownership(found: DataFrame) -> DataFrame:
    """value_hash, repositories, owners over all candidates; a null owner counts as one owner.

    Each document is taken as a repository. Distinct pairs are formed before the counts, so a
    value that a third of all documents share is spread over tasks and summed in parts.
    """
    values = found.select("id", "key", "owner", F.explode(F.concat("base", "opaque")).alias("span"))
    return (
        values.select(F.sha2("span.value", 256).alias("value_hash"), F.struct("owner").alias("o"), F.struct("id", "key").alias("r"))
        .groupBy("value_hash")
        .agg(F.count_distinct("r").alias("repositories"), F.count_distinct("o").alias("owners"))
    )


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    owner_column: str = "source",
    example_owners: int = 3,
    example_repositories: int = 50,
) -> DataFrame:
    """id, key, base (spans), findings (all spans with ownership and verdict) for every row of ``docs``.

    Base spans are always findings. A value that ``example_owners`` owners or
    ``example_repositories`` repositories have is an ``example``: a credential in use is not
    copied that widely, not even by its owner. Others are ``owned``. Opaque tokens are added where
    they are owned and no base span covers them. Every finding states how many repositories and
    owners have its value. Work is in proportion to the matches, also of one very long text.
    Null and empty texts have no findings; equal rows get the same ones and count as one repository.
    """
    found = written(candidates(docs, id_column, text_column, owner_column), "candidates")
    counted = written(ownership(found), "ownership")
    spans = found.where((F.size("base") > 0) | (F.size("opaque") > 0)).select("id", "key", F.explode(F.concat("base", "opaque")).alias("span"))
    spans = spans.select("id", "key", "span.*", F.sha2("span.value", 256).alias("value_hash")).drop("value")
    # How far the base spans reach that start no later than this one.
    before = Window.partitionBy("id", "key").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max(F.when(F.col("kind") != "opaque", F.col("end"))).over(before)
    spans = spans.withColumn("covered", F.coalesce(reach >= F.col("end"), F.lit(False)))
    copied = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories)
    judged = spans.join(counted, "value_hash").withColumn("verdict", F.when(copied, "example").otherwise("owned"))
    judged = judged.where((F.col("kind") != "opaque") | ((F.col("verdict") == "owned") & ~F.col("covered")))
    finding = F.struct("start", "rank", "end", "kind", "value_hash", "repositories", "owners", "verdict")
    by_doc = judged.groupBy(F.col("id").alias("found_id"), F.col("key").alias("found_key")).agg(
        F.array_sort(F.collect_set(finding)).alias("findings")
    )
    joined = found.join(by_doc, F.col("id").eqNullSafe(F.col("found_id")) & F.col("key").eqNullSafe(F.col("found_key")), "left")
    nothing = F.array().cast(by_doc.schema["findings"].dataType)
    return joined.select("id", "key", "base", F.coalesce("findings", nothing).alias("findings"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span by start, then kind, comma-joined."""
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(text, ",")


def count_of(spans: Column, kind: str) -> Column:
    return let(spans, lambda a: F.size(F.filter(a, lambda s: s["kind"] == kind))).cast("bigint")
