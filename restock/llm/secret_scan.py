"""Secret scan with corpus-wide ownership frequency; built-in functions only.

Candidates are found by patterns, with their places in code points: cutting a text at a pattern gives
the gaps between its matches, and running sums of gaps and matches give the places. The value of every
candidate is hashed, and the hashes are counted over distinct repositories and owners, summing up in
three steps so that a value copied everywhere is reduced before it is shuffled. A value that at least
``widely`` owners hold is an example that was copied around; others belong to their owner.

Three kinds are reported always: ``assign``, ``access`` and ``hex``. The method adds ``credential``:
known key prefixes, signed tokens, key headers, passwords in URLs and long mixed tokens, as long as
they look alive: held by fewer than ``widely`` owners and not inside a span of the other kinds.

Defined cases: a null text is empty. A null repository or owner counts as one of its own. Rows that
repeat are reported for each row and count once in the frequencies. Kinds may overlap one another. A
text without spans has zero counts and an empty list of spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock.llm.common import fresh, identified, written

# Fixed formats: pattern, group that holds the value, least length of that value.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
# Runs shorter than 32 cannot match, so the bound stands in the pattern and short runs cost nothing.
HEX = r"[0-9a-f]{32,}"
CREDENTIAL = (
    r"(?<![A-Za-z0-9_+/=-])(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|[A-Za-z0-9+/_=-]{24,})"
    r"|-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----|://[^\s/:@]{1,64}:[^\s/:@]{4,128}@"
)
KINDS = [("assign", ASSIGN, 1, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32), ("credential", CREDENTIAL, 0, 16)]
BASE = ["assign", "access", "hex"]
WIDELY = 3
MARK = "[REDACTED]"

_SPAN = "struct<kind: string, i: int, gap: int, size: int, value: string>"


def _matches(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Matches of one pattern: number, code points since the last match, own code points, value."""
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), values.alias("value"))
    spans = F.transform(
        F.filter(zipped, lambda z: z["whole"].isNotNull()),
        lambda z, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            F.length(z["gap"]).alias("gap"),
            F.length(z["whole"]).alias("size"),
            z["value"].alias("value"),
        ),
    )
    return F.when(text.rlike(pattern), spans).otherwise(F.from_json(F.lit("[]"), f"array<{_SPAN}>"))


def holds_candidate(text: Column) -> Column:
    return F.coalesce(F.greatest(*[text.rlike(pattern) for _, pattern, _, _ in KINDS]), F.lit(False))


def candidates(rows: DataFrame) -> DataFrame:
    """Spans of rows (row, repo, owner, text), one per row: kind, start, end and the value's hash."""
    found = F.concat(*[_matches(F.coalesce("text", F.lit("")), *kind[:3]) for kind in KINDS])
    spans = rows.select("row", "repo", "owner", F.explode(found).alias("span")).select("row", "repo", "owner", "span.*")
    before = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    least = F.coalesce(*[F.when(F.col("kind") == kind, size) for kind, _, _, size in KINDS])
    placed = spans.repartition("row").withColumn("end", end).filter(F.length("value") >= least)
    return placed.select(
        "row",
        "repo",
        "owner",
        "kind",
        (F.col("end") - F.col("size")).alias("start"),
        "end",
        F.sha2("value", 256).alias("digest"),
        _mixed("value").alias("mixed"),
    )


def _mixed(value: str) -> Column:
    """Whether a value looks drawn at random, not written: letters, digits and many different signs."""
    digits, letters = F.length(F.regexp_replace(value, "[^0-9]", "")), F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
    kinds = F.size(F.array_distinct(F.split(value, "")))
    return ((digits >= 3) & (letters >= 3) & (kinds >= 10)) | F.col(value).rlike("^(-----BEGIN|://)")


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every value, by its hash."""
    held = found.groupBy("digest", "owner", "repo").agg(F.count(F.lit(1)).alias("spans"))
    by_owner = held.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return by_owner.groupBy("digest").agg(F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"))


def judged(found: DataFrame, widely: int = WIDELY) -> DataFrame:
    """Reported spans with ``repos``, ``owners`` and ``live``; added ones only where they look alive."""
    is_base = F.col("kind").isin(BASE)
    place = Window.partitionBy("row").orderBy("start", F.col("end").desc())
    earlier = F.max(F.when(is_base, F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    later = F.min(F.when(is_base, F.col("start"))).over(place.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    free = (F.coalesce(earlier, F.lit(0)) <= F.col("start")) & (F.coalesce(later, F.col("end")) >= F.col("end"))
    known = found.join(ownership(found), "digest").withColumn("live", F.col("owners") < widely)
    return known.withColumn("free", free).filter(is_base | (F.col("free") & F.col("live") & F.col("mixed")))


def _listed(condition: Column) -> Column:
    """Spans as kind:start:end, by start and then by kind, joined by commas."""
    rank = F.coalesce(*[F.when(F.col("kind") == kind, at) for at, (kind, _, _, _) in enumerate(KINDS)])
    span = F.struct(F.col("start"), rank.alias("rank"), F.concat_ws(":", "kind", "start", "end").alias("span"))
    ordered = F.array_sort(F.collect_list(F.when(condition, span)))
    return F.array_join(F.transform(ordered, lambda s: s["span"]), ",")


def scan(docs: DataFrame, repo: Column, owner: Column, widely: int = WIDELY) -> DataFrame:
    """Per row of documents: counts by kind, spans, and how many spans are live and how many are examples."""
    row = fresh(docs, "_row")
    rows = identified(docs, row).select(F.col(row).alias("row"), "doc_id", repo.alias("repo"), owner.alias("owner"), "text")
    found = written(candidates(rows))
    per_row = judged(found, widely).groupBy("row").agg(
        *[F.count(F.when(F.col("kind") == kind, 1)).alias(f"n_{kind}") for kind in [*BASE, "credential"]],
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.count(F.when(~F.col("live"), 1)).alias("n_example"),
        F.max("owners").alias("most_owners"),
        F.max("repos").alias("most_repos"),
        _listed(F.col("kind").isin(BASE)).alias("base"),
        _listed(F.lit(True)).alias("spans"),
    )
    numbers = [name for name in per_row.columns if name not in ("row", "base", "spans")]
    return (
        rows.select("row", "doc_id")
        .join(per_row, "row", "left")
        .select(
            "doc_id",
            *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in numbers],
            F.coalesce("base", F.lit("")).alias("base"),
            F.coalesce("spans", F.lit("")).alias("spans"),
        )
    )


def redacted(docs: DataFrame, repo: Column, owner: Column, widely: int = WIDELY) -> DataFrame:
    """The documents with every reported span replaced by ``MARK``; others are not touched or moved."""
    row = fresh(docs, "_row")
    placed = identified(docs, row)
    holding = placed.filter(holds_candidate(F.col("text")))
    rows = holding.select(F.col(row).alias("row"), repo.alias("repo"), owner.alias("owner"), "text")
    found = judged(written(candidates(rows)), widely)
    spans, text, length = fresh(docs, "_spans"), F.col("text"), F.length("text")
    lists = found.groupBy(F.col("row").alias(row)).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(spans))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        gap = F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int")))
        return F.when(
            span["start"] >= done["at"], F.struct(span["end"].alias("at"), F.concat(gap, F.lit(MARK)).alias("out"))
        ).otherwise(F.struct(F.greatest(done["at"], span["end"]).alias("at"), done["out"].alias("out")))

    def rest(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), length))

    replaced = F.when(F.col(spans).isNotNull(), F.aggregate(F.col(spans), start, step, rest)).otherwise(text)
    changed = holding.join(lists, row, "left").withColumn("text", replaced)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.col(spans).isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        changed = changed.withColumn("n_chars", counted)
    untouched = placed.select(docs.columns).filter(~holds_candidate(F.col("text")))
    return untouched.unionByName(changed.select(docs.columns))
