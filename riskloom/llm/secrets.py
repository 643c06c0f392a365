"""Secret scan with corpus-wide ownership, in DataFrame functions only.

Candidates are found per document.  Their hashes are counted over the whole
corpus by distinct repository and owner: a value that several owners or many
repositories have is a copied example, another one that looks drawn is taken
for live.  The method adds two kinds of span: ``vendor`` (tokens with a known prefix) and
``live`` (the value of a candidate that is taken for live).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import identified, small_side
from riskloom.sources.storage import materialize


@dataclass(frozen=True)
class Kind:
    """A pattern; the value is its ``group`` and ends where the match ends."""

    name: str
    pattern: str
    group: int
    least: int
    hint: str


# A cheap test that every match passes comes first, so few texts meet the pattern.
KINDS = [
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, r"(?i:passw|secret|token|api_?key)"),
    Kind("access", r"(AKIA[A-Z0-9]{16,})", 1, 20, "AKIA"),
    Kind("hex", r"([0-9a-f]{24,})", 1, 24, r"[0-9a-f]{24}"),
    Kind("vendor", r"((?:gh[pousr]_|glpat-|xox[abprs]-|sk_live_|sk-)[A-Za-z0-9_-]{16,})", 1, 20,
         "gh[pousr]_|glpat-|xox|sk"),
]
BASE_KINDS = ("assign", "access", "hex")
ORDER = [k.name for k in KINDS] + ["live"]
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 10
MARK = "[SECRET]"


def _matches(text: Column, kind: Kind) -> Column:
    """Array of (kind, gap since the last match, length, value), in text order.

    The pieces between matches come from a split by the same pattern, so gaps
    and lengths together give every position, in code points.
    """
    pattern = F.lit(kind.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(kind.group))
    zipped = F.arrays_zip(F.split(text, kind.pattern).alias("gap"), whole.alias("whole"), value.alias("value"))
    found = F.transform(F.filter(zipped, lambda x: x["whole"].isNotNull()), lambda x: F.struct(
        F.lit(kind.name).alias("kind"), F.length(x["gap"]).alias("gap"),
        F.length(x["whole"]).alias("len"), x["value"].alias("value")))
    empty = F.array().cast("array<struct<kind:string,gap:int,len:int,value:string>>")
    return F.when(text.rlike(kind.hint), found).otherwise(empty)


def candidates(docs: DataFrame, row: str, *others: str) -> DataFrame:
    """``others`` with kind, start, end, value_start, value: one row per match.

    ``row`` tells the rows of ``docs`` apart; they have text, repository and owner.
    """
    kept = [row, "repository", "owner", *others]
    every = F.concat(*[_matches(F.col("text"), kind) for kind in KINDS])
    rows = docs.select(*kept, F.posexplode(every).alias("place", "m"))
    before = Window.partitionBy(row, "kind").orderBy("place")
    least = F.create_map(*[F.lit(x) for k in KINDS for x in (k.name, k.least)])
    return (rows.select(*kept, "place", "m.*")
            .withColumn("end", F.sum(F.col("gap") + F.col("len")).over(before))
            .withColumn("start", F.col("end") - F.col("len"))
            .where(F.length("value") >= F.element_at(least, F.col("kind")))
            .withColumn("value_start", F.col("end") - F.length("value"))
            .select(*kept, "kind", "start", "end", "value_start", "value"))


def ownership(found: DataFrame) -> DataFrame:
    """(value_hash, n_repositories, n_owners) over all candidates.

    Duplicates go before each count, on the map side first, so a value that
    fills a third of the corpus reaches a task only once per repository.
    """
    seen = found.select("value_hash", "owner", "repository").distinct()
    by_owner = seen.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("value_hash").agg(F.sum("n").alias("n_repositories"),
                                              F.count(F.lit(1)).alias("n_owners"))


def looks_live(value: Column) -> Column:
    """Whether a value has the spread of characters that a drawn one has.

    A drawn value uses many of the characters it could: from 8 characters on, at
    least 5 different ones, and at least 8 from 20 characters on, however they
    are placed.  Shorter ones than 20 need a digit besides, as words have none.
    """
    different = F.size(F.array_distinct(F.regexp_extract_all(value, F.lit("."), F.lit(0))))
    return ((F.length(value) >= 20) & (different >= 8)) | (
        (F.length(value) >= 8) & (different >= 5) & value.rlike("[0-9]"))


def judged(found: DataFrame) -> DataFrame:
    """``found`` with n_repositories, n_owners and ``class`` by the value's ownership and look.

    A value that ``EXAMPLE_OWNERS`` owners or ``EXAMPLE_REPOSITORIES``
    repositories have is a widely copied ``example``; of the others, those that
    look drawn are ``live`` and the rest ``weak``.
    """
    hashed = materialize(found.withColumn("value_hash", F.sha2("value", 256)))
    copied = (F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_repositories") >= EXAMPLE_REPOSITORIES)
    return hashed.join(ownership(hashed), "value_hash", "left").withColumn(
        "class", F.when(copied, "example").when(looks_live(F.col("value")), "live").otherwise("weak"))


def find_secrets(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """One row per span: doc_id, kind, start, end, class, n_repositories, n_owners.

    For ``class`` see ``judged``.  A null repository or owner counts as one of
    that name.  Null texts hold nothing; rows without id and repeated ids are
    treated as ``identified`` says.
    """
    known = identified(docs.select("doc_id", "text", *_of(repository, owner)), "repository", "owner")
    every = judged(candidates(known, "doc_id"))
    kept = ["doc_id", "kind", "start", "end", "class", "n_repositories", "n_owners"]
    live = every.where("class = 'live'").withColumn("kind", F.lit("live")).withColumn(
        "start", F.col("value_start")).select(*kept).distinct()
    return every.select(*kept).unionByName(live)


def _of(repository: Column, owner: Column) -> list[Column]:
    return [F.coalesce(repository, F.lit("")).alias("repository"), F.coalesce(owner, F.lit("")).alias("owner")]


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def span_digests(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """One row per document id: counts and digests of its spans, empty where it has none."""
    rank = F.array_position(F.array(*[F.lit(k) for k in ORDER]), F.col("kind"))
    rows = spans.select("doc_id", F.struct("start", rank.alias("rank"), "end", "kind", "class").alias("s"))
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
    every = ids.withColumn("s", F.lit(None).cast(rows.schema["s"].dataType)).unionByName(rows)
    listed = every.groupBy("doc_id").agg(F.sort_array(F.collect_list("s")).alias("s"))

    def joined(array: Column) -> Column:
        return F.array_join(F.transform(array, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(test) -> Column:
        return F.size(F.filter("s", test)).cast("bigint")

    base = F.filter("s", lambda x: x["kind"].isin(*BASE_KINDS))
    return listed.select(
        "doc_id", *[count(_of_kind(k)).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"),
        count(_of_kind("live")).alias("n_live"),
        count(lambda x: (x["class"] == "example") & x["kind"].isin(*BASE_KINDS)).alias("n_example"))


def redact_live(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """``docs`` with live values replaced by a mark; null texts become empty.

    ``n_chars`` follows the new text.  Every row counts and is masked by its own
    text, whether its id is null or repeated: spans are looked up by the text's
    128-bit digest, under which equal texts have equal spans.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.md5(text).alias("_text"),
                       text.alias("text"), *_of(repository, owner))
    live = judged(candidates(rows, "row", "_text")).where("class = 'live'")
    spans = live.select("_text", F.col("value_start").alias("start"), "end").distinct()
    listed = spans.groupBy("_text").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_live"))

    def merge(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joint = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return (F.when(F.size(done) == 0, F.array(x))
                .when(x["start"] > last["end"], F.concat(done, F.array(x)))
                .otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joint))))

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    spans = F.aggregate("_live", none, merge)
    edges = F.concat(F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end"))), spans)
    pieces = F.transform(edges, lambda x, i: F.substring(
        text, x["end"].cast("int") + 1,
        F.coalesce(F.get(edges, i + 1)["start"] - x["end"], F.length(text).cast("bigint")).cast("int")))
    joined = docs.withColumn("_text", F.md5(text)).join(small_side(listed), "_text", "left")
    redacted = F.when(F.col("_live").isNotNull(), F.array_join(pieces, MARK)).otherwise(text)
    return (joined.withColumn("text", redacted).withColumn("n_chars", F.length("text").cast("bigint"))
            .select(*docs.columns))
