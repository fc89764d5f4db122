"""Secret scan with corpus-wide ownership frequency, in built-in functions only.

Three fixed patterns give the base spans. A fourth, `generic`, finds long runs of token characters
with a letter and a digit that overlap no base span. The values of all candidates are hashed and
counted over the corpus: in how many distinct repositories and with how many distinct owners each
occurs. A value with at least `wide` owners is a widely copied example; the others are
owner-specific and look live. Base spans always stay; the method adds the generic spans whose value
looks live (kind `live`).

Positions come from the pieces between matches: lengths are summed along a document in a window, so
the work is linear in the matches. Values are counted per owner and repository before the counts
meet, so a value in a third of all rows is pre-aggregated; the join back is on the hash of the
value and left to adaptive execution to split.

Defined results: a null text is an empty one and has no span; a document is known by its id and
its text, so rows that repeat both are scanned once and each gets the spans, and rows that share
only the id stay apart; null ids, owners and repositories count as values; empty tables give an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradepath.llm.common import cut, fresh

# Fixed patterns. (?i: ) folds ASCII letters only.
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))"
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: kind: (pattern, what a document must match to be taken apart, group, least length of it)
BASE = {
    "assign": (ASSIGN, ASSIGN, 2, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", r"AKIA[A-Z0-9]{14}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", r"[0-9a-f]{16}", 0, 16),
}
GENERIC = {"generic": (r"[A-Za-z0-9+/_=-]{20,}", r"[A-Za-z0-9+/_=-]{20}", 0, 20)}
#: Owners from which on a value is a widely copied example.
WIDE = 3
ORDER = ["assign", "access", "hex", "live"]


def _matches(docs: DataFrame, kind: str, rule: tuple) -> DataFrame:
    """Rows _doc, _h, _owner, _kind, _start, _end, _value for the matches of one pattern."""
    pattern, needs, group, least = rule
    text = F.col("_text")
    found = docs.where(text.rlike(needs)).select(
        "_doc", "_h", "_owner",
        F.posexplode(F.arrays_zip(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
            F.split(text, pattern, -1).alias("before"))).alias("_i", "_z"),
    )
    # the last piece has no match behind it
    found = found.select("_doc", "_h", "_owner", "_i", F.col("_z.m").alias("_m"),
                         F.length("_z.before").cast("long").alias("_before")).where("_m IS NOT NULL")
    found = found.groupBy("_doc", "_h", "_owner", "_i").agg(
        F.first("_m").alias("_m"), F.first("_before").alias("_before"))
    upto = W.partitionBy("_doc", "_h", "_owner").orderBy("_i")
    size = F.length("_m")
    end = F.sum(F.col("_before") + size).over(upto)
    value = F.regexp_extract("_m", pattern, group) if group else F.col("_m")
    return (
        found.select("_doc", "_h", "_owner", F.lit(kind).alias("_kind"),
                     (end - size).alias("_start"), end.alias("_end"), value.alias("_value"))
        .where(F.length("_value") >= least)
    )


def _span() -> Column:
    return F.struct(F.col("_start").alias("start"), F.col("_rank").alias("rank"),
                    F.col("_end").alias("end"), F.col("_kind").alias("kind"),
                    F.col("_value").alias("value"), F.col("_live").alias("live"))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 owner: str = "source", repository: str | None = None,
                 wide: int = WIDE) -> DataFrame:
    """A row for each row of docs: doc_id, text_hash, and spans, an array of
    struct(start, rank, end, kind, value, live) by start and kind, with places in code points.
    Each document is a repository of its own unless a column names one, and its own owner if there
    is no column of owners."""
    owner = owner if owner in docs.columns else doc_id
    plain = docs.select(
        F.col(doc_id).alias("_doc"), F.coalesce(text, F.lit("")).alias("_text"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("_owner_name"),
        F.coalesce(F.col(repository or doc_id).cast("string"), F.lit("")).alias("_repo"),
    ).select("_doc", "_text", F.xxhash64("_text").alias("_h"),
             F.struct(F.col("_owner_name").alias("owner"), F.col("_repo").alias("repo")).alias("_owner"))
    rows = None
    for kind, rule in {**BASE, **GENERIC}.items():
        one = _matches(plain, kind, rule)
        rows = one if rows is None else rows.unionByName(one)
    rows = cut(rows)
    doc = ["_doc", "_h", "_owner"]
    # generic runs that no base span touches: the base ends before, going from left to right and back
    ends = F.max(F.when(F.col("_kind") != "generic", F.col("_end"))).over(
        W.partitionBy(*doc).orderBy("_start", "_base").rowsBetween(W.unboundedPreceding, -1))
    starts = F.min(F.when(F.col("_kind") != "generic", F.col("_start"))).over(
        W.partitionBy(*doc).orderBy("_start", "_base").rowsBetween(1, W.unboundedFollowing))
    rows = rows.withColumn("_base", (F.col("_kind") == "generic").cast("int")).select(
        *doc, "_kind", "_start", "_end", "_value", F.sha2("_value", 256).alias("_hash"),
        F.coalesce(ends <= F.col("_start"), F.lit(True)).alias("_left"),
        F.coalesce(starts >= F.col("_end"), F.lit(True)).alias("_right"))
    rows = rows.where("_kind != 'generic' OR (_left AND _right "
                      "AND _value RLIKE '[0-9]' AND _value RLIKE '[A-Za-z]')")
    # owners and repositories of each value
    spread = (
        rows.groupBy("_hash", "_owner").agg(F.lit(1).alias("_one"))
        .groupBy("_hash", "_owner.owner").agg(F.count("*").alias("_n"))
        .groupBy("_hash").agg(F.count("*").alias("n_owners"), F.sum("_n").alias("n_repos"))
    )
    kind = F.when(F.col("_kind") == "generic", "live").otherwise(F.col("_kind"))
    live = (F.col("n_owners") < wide) | (F.col("n_repos") < wide)
    rows = (
        rows.join(spread, "_hash").withColumn("_live", live)
        .where("_kind != 'generic' OR _live").withColumn("_kind", kind)
        .withColumn("_rank", F.array_position(F.lit(ORDER), F.col("_kind")).cast("int"))
    )
    spans = rows.groupBy("_doc", "_h").agg(
        F.array_sort(F.collect_set(_span())).alias("spans"))
    spans = spans.withColumnsRenamed({"_doc": "_d", "_h": "_g"})
    ids = plain.select("_doc", "_h")
    empty = F.array().cast(spans.schema["spans"].dataType)
    return ids.join(
        spans, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g")), "left"
    ).select(F.col("_doc").alias(doc_id), F.col("_h").alias("text_hash"),
             F.coalesce("spans", empty).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The counts and listings of the spans that find_secrets gives."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] != "live")

    def count(test):
        return F.size(F.filter(spans, test)).cast("long")

    def of(kind):
        return lambda s: s["kind"] == kind

    return found.select(
        doc_id,
        *(count(of(kind)).alias(f"n_{kind}") for kind in BASE),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        count(of("live")).alias("n_added"),
        count(lambda s: ~s["live"]).alias("n_widely_copied"),
    )


def redact(docs: DataFrame, mask: str = "[secret]", doc_id: str = "doc_id", text: str = "text",
           **options) -> DataFrame:
    """docs with the owner-specific values masked; widely copied examples stay. Rows and columns
    stay as they are; a null text stays null."""
    d, g, spans = fresh("doc"), fresh("hash"), fresh("spans")
    found = find_secrets(docs, doc_id, text, **options).select(
        F.col(doc_id).alias(d), F.col("text_hash").alias(g),
        F.filter("spans", lambda s: s["live"]).alias(spans),
    ).where(F.size(spans) > 0).dropDuplicates([d, g])
    # one step per span, from the left: what is kept so far, and the place reached
    body = docs[text]
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    masked = F.aggregate(
        spans, state,
        lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(F.struct(
            F.concat(a["out"], F.when(s["start"] >= a["at"], F.concat(
                body.substr(a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int")),
                F.lit(mask))).otherwise(F.lit(""))).alias("out"),
            s["end"].alias("at"))),
        lambda a: F.concat(a["out"], body.substr(a["at"].cast("int") + 1, F.length(body))),
    )
    joined = docs.join(
        found, docs[doc_id].eqNullSafe(found[d]) & (F.xxhash64(docs[text]) == found[g]), "left")
    return joined.select(*(
        F.when(F.col(spans).isNotNull(), masked).otherwise(docs[c]).alias(c)
        if c == text else docs[c] for c in docs.columns))
