"""Secret scans with corpus-wide ownership frequency.

Base kinds are found by patterns in each text. Further candidates, long tokens that mix digits and both
cases, are judged by who has them: the hash of a candidate is counted over distinct owners and
repositories of the whole corpus. A value that many owners have is a copied example; one that belongs to
few looks live and becomes a span of kind token. Base spans stay, and are counted as live or example too.
Only DataFrame functions are used.

Nulls, ties and odd rows: a null or empty text has no spans and the digest of the empty string; null
sources and languages are one owner; rows repeated with the same id and text get the same result; a span
of one kind may overlap one of another; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmeter.llm.common import stored

# The kinds in order, with pattern and least length (of group 2 for assign).
ASSIGN = (
    "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
KINDS = ["assign", "access", "hex", "token"]
# A run of 16 or more is the whole run, so shorter runs need no match of their own; alike for access.
ACCESS, HEX = "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}"
TOKEN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
#: Distinct owners up to which a value counts as theirs.
MAX_OWNERS = 2


def _found(pattern: str, kind: str, text: str = "t") -> Column:
    """Spans of all matches: kind's place, start, end in code points, value (group 2 or the match)."""
    group = 2 if kind == "assign" else 0
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # The text between matches, from split, gives their places.
    gaps = F.split(text, pattern, -1)
    both = F.arrays_zip(gaps.alias("g"), matches.alias("m"), values.alias("v"))
    both = F.filter(both, lambda x: x["m"].isNotNull())
    one = "array_repeat(named_struct('start', 0L, 'ord', 0, 'end', 0L, 'value', ''), 0)"

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.char_length(x["g"])
        end = start + F.char_length(x["m"])
        span = F.struct(
            start.cast("long").alias("start"),
            F.lit(KINDS.index(kind)).alias("ord"),
            end.cast("long").alias("end"),
            x["v"].alias("value"),
        )
        return F.struct(end.cast("long").alias("at"), F.concat(a["out"], F.array(span)).alias("out"))

    all_spans = F.aggregate(
        both, F.expr(f"named_struct('at', 0L, 'out', {one})"), step, lambda a: a["out"]
    )
    return F.when(F.col(text).rlike(pattern), all_spans).otherwise(F.expr(one))


def _scanned(docs: DataFrame) -> DataFrame:
    text = docs.select(
        "doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("t")
    )
    base = text.select(
        "doc_id",
        "lang",
        "source",
        F.xxhash64("t", F.char_length("t")).alias("text_hash"),
        F.filter(_found(ASSIGN, "assign"), lambda s: F.char_length(s["value"]) >= 12).alias("assign"),
        _found(ACCESS, "access").alias("access"),
        _found(HEX, "hex").alias("hex"),
        F.filter(
            _found(TOKEN, "token"),
            lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]"),
        ).alias("more"),
    )
    base = base.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    apart = F.filter(
        "more",
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return base.select(
        "doc_id",
        "lang",
        "source",
        "text_hash",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        "base",
        apart.alias("more"),
    )


def _ownership(candidates: DataFrame) -> DataFrame:
    """(value_hash, n_owners, n_repositories): pre-aggregated, so a value in every text is few rows."""
    each = candidates.groupBy("value_hash", "source", "lang").agg(F.count(F.lit(1)).alias("n"))
    owner = each.groupBy("value_hash", "source").agg(F.count(F.lit(1)).alias("r"))
    return owner.groupBy("value_hash").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("r").alias("n_repositories")
    )


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    name = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.get(kinds, s["ord"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(name, ",")


def secrets(docs: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, found, text_hash) for
    each row of docs (doc_id, text, lang, source). An owner is a source, a repository its share in one
    language; found holds the spans as structures."""
    scanned = stored(_scanned(docs))
    key = ["doc_id", "text_hash"]
    hit = scanned.where((F.size("base") > 0) | (F.size("more") > 0))
    # A value's hash is salted neither by kind nor by place: one credential is one value.
    single = hit.select(*key, "lang", "source", F.explode(F.concat("base", "more")).alias("s"))
    single = single.withColumn("value_hash", F.xxhash64("s.value"))
    judged = single.join(_ownership(single), "value_hash")
    judged = judged.withColumn("live", F.col("n_owners") <= max_owners)
    rows = judged.groupBy(*key).agg(
        F.array_distinct(
            F.array_sort(F.collect_list(F.when((F.col("s.ord") < 3) | F.col("live"), F.col("s"))))
        ).alias("found"),
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_example"),
    )
    rows = rows.withColumnsRenamed({k: f"_{k}" for k in key})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    nothing = F.expr("array_repeat(named_struct('start', 0L, 'ord', 0, 'end', 0L, 'value', ''), 0)")
    found = F.coalesce("found", nothing)
    return scanned.join(rows, on, "left").select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(found).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
        found.alias("found"),
        "text_hash",
    )


def _masked(spans: str, mark: str) -> Column:
    """The column text with each of the sorted spans replaced by the mark."""

    def step(a: Column, s: Column) -> Column:
        # A span that begins before the last one's end only moves that end.
        before = F.substring(F.col("text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        fresh = s["start"] >= a["at"]
        return F.struct(
            F.when(fresh, s["end"]).otherwise(F.greatest(a["at"], s["end"])).alias("at"),
            F.when(fresh, F.concat(a["out"], before, F.lit(mark))).otherwise(a["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda a: F.concat(a["out"], F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.lit(2**31 - 1)))
    masked = F.aggregate(spans, start, step, rest)
    return F.when(F.coalesce(F.size(spans), F.lit(0)) > 0, masked).otherwise(F.col("text"))


def redacted(docs: DataFrame, mark: str = "[SECRET]", max_owners: int = MAX_OWNERS) -> DataFrame:
    """docs with each found span replaced by the mark; overlapping spans become one mark. Only texts with a
    long token, whose verdict hangs on the corpus, are joined with it; base spans are replaced where the
    text lies. Column names that begin with __llm_ are reserved."""
    text = F.coalesce("text", F.lit(""))
    hangs = text.rlike(TOKEN)
    base = F.array_sort(
        F.concat(
            F.filter(_found(ASSIGN, "assign", "__llm_text"), lambda s: F.char_length(s["value"]) >= 12),
            _found(ACCESS, "access", "__llm_text"),
            _found(HEX, "hex", "__llm_text"),
        )
    )
    alone = docs.where(~hangs).withColumn("__llm_text", text).withColumn("__llm_found", base)
    alone = alone.withColumn("text", _masked("__llm_found", mark)).drop("__llm_text", "__llm_found")
    found = secrets(docs, max_owners).where("spans <> ''")
    found = found.select(
        F.col("doc_id").alias("__llm_id"), F.col("text_hash").alias("__llm_hash"), F.col("found").alias("__llm_found")
    )
    found = found.dropDuplicates(["__llm_id", "__llm_hash"])
    own = docs.where(hangs).withColumn("__llm_own", F.xxhash64(text, F.char_length(text)))
    joined = own.join(
        found, F.col("doc_id").eqNullSafe(F.col("__llm_id")) & (F.col("__llm_own") == F.col("__llm_hash")), "left"
    )
    joined = joined.withColumn("text", _masked("__llm_found", mark))
    return alone.unionByName(joined.drop("__llm_own", "__llm_id", "__llm_hash", "__llm_found"))
