"""Secrets in texts, and whose they are. DataFrame functions only.

Patterns give candidate spans: ``assign`` (a value given to a name such as password or token),
``access`` (access key ids), ``hex`` (long runs of hex digits) and ``mixed`` (long runs of letters, digits
and ``+/_=-`` that hold lower and upper case and digits). Matches are leftmost and do not overlap within
a kind; positions are code points, ends exclusive.

The hash of each candidate's secret part is aggregated over the whole corpus: by how many distinct
repositories and owners does it occur? A value of at most ``max_owners`` owners in at most ``max_repos``
repositories is specific to them and looks live; others are widely copied examples. The first three
kinds are always reported. A mixed run is reported when it looks live and overlaps none of those.

Counting goes by (hash, owner, repository) first, so a value that a third of all documents hold shrinks
to one row per task, owner and repository before it is shuffled. The verdicts are written before they
are joined back, which leaves both sides of that join to be split by adaptive execution.

Nulls: a null text counts as empty; a null owner or repository counts as one more. Repeated rows are
scanned one by one. Other columns are ignored by ``scan`` and passed on by ``redact``. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.functions.signals import quoted
from gustline.llm.names import fresh
from gustline.session import stage

# Patterns and least lengths are fixed values.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIXED = r"[A-Za-z0-9+/_=-]{20,}"
LEAST_VALUE = 6
KINDS = ["assign", "access", "hex", "mixed"]
ALWAYS = 3  # the first kinds are reported whoever owns them

MAX_OWNERS = 1
MAX_REPOS = 2
MARK = "[SECRET]"


def _spans(text: Column, kind: int, pattern: str, group: int) -> Column:
    """Array of (start, kind, finish, hash) of all matches, from the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), value.alias("value"))
    none = F.array().cast("array<struct<start:int,kind:int,finish:int,hash:string,size:int>>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        finish = start + F.length(part["hit"])
        span = F.struct(
            start.cast("int").alias("start"), F.lit(kind).alias("kind"), finish.cast("int").alias("finish"),
            F.md5(part["value"]).alias("hash"), F.length(part["value"]).cast("int").alias("size"),
        )
        return F.struct(finish.cast("int").alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    whole = F.filter(parts, lambda part: part["hit"].isNotNull())
    spans = F.aggregate(whole, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda state: state["out"])
    return F.when(text.rlike(pattern), spans).otherwise(none)


def _candidates(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """One row per document with its candidate spans; the key is written, so it stays what it is."""
    text = F.col("text")
    kept = docs.select("doc_id", owner.alias("owner"), repo.alias("repo"), F.coalesce(text, F.lit("")).alias("text"))
    kept = kept.select(
        F.monotonically_increasing_id().alias("key"), "doc_id", "owner", "repo",
        F.filter(_spans(text, 0, ASSIGN, 2), lambda s: s["size"] >= LEAST_VALUE).alias("assign"),
        _spans(text, 1, ACCESS, 0).alias("access"),
        _spans(text, 2, HEX, 0).alias("hex"),
        _mixed(text).alias("mixed"),
    )
    return kept.select("key", "doc_id", "owner", "repo", F.concat("assign", "access", "hex").alias("base"), "mixed")


def _mixed(text: Column) -> Column:
    """Mixed runs; the test for the three classes comes before positions are worked out."""
    pattern = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[A-Z0-9+/_=-]*[a-z])(?=[a-z0-9+/_=-]*[A-Z])" + MIXED
    return _spans(text, 3, pattern, 0)


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, owners, repos) of each hash of ``candidates`` (hash, owner, repo)."""
    return (
        candidates.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("times"))
        .groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
        .groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"))
    )


def _judged(docs: DataFrame, owner: Column, repo: Column, max_owners: int, max_repos: int) -> DataFrame:
    """Per document: base spans, all reported spans and the numbers of live and copied candidates."""
    table = stage(_candidates(docs, owner, repo), "secret-candidates")
    spans = table.select("key", "owner", "repo", F.explode(F.concat("base", "mixed")).alias("span"))
    counted = stage(ownership(spans.select("span.hash", "owner", "repo")), "secret-owners")
    live = (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
    told = spans.select("key", "span", F.col("span.hash").alias("hash")).join(counted.select("hash", live.alias("live")), "hash")
    told = told.groupBy("key").agg(
        F.collect_set(F.when(F.col("live"), F.struct("span.start", "span.kind"))).alias("live"), F.count(F.lit(1)).alias("n_candidates")
    )
    none = F.array().cast("array<struct<start:int,kind:int>>")
    joined = table.join(told, "key", "left").withColumn("live", F.coalesce("live", none))
    added = F.filter(
        "mixed",
        lambda m: F.array_contains("live", F.struct(m["start"].alias("start"), m["kind"].alias("kind")))
        & ~F.exists("base", lambda b: (b["start"] < m["finish"]) & (m["start"] < b["finish"])),
    )
    return joined.select(
        "key", "doc_id", "base", F.concat("base", added).alias("spans"), F.size("live").cast("long").alias("n_live"),
        (F.coalesce("n_candidates", F.lit(0)) - F.size("live")).cast("long").alias("n_copied"),
    )


def _listed(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["finish"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def scan(docs: DataFrame, *, owner: Column, repo: Column, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """Numbers of spans, checksum of the base spans and the list of all spans, per document."""
    judged = _judged(docs, owner, repo, max_owners, max_repos)
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")
    return judged.select(
        "doc_id", *map(number, range(ALWAYS)), F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"),
        "n_live", "n_copied",
    )


def redact(docs: DataFrame, *, owner: Column, repo: Column, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """The documents with all their columns, each reported span replaced by a mark.

    Documents are matched with their spans by a hash of id and text, so repeated ids are safe.
    """
    mark, held = fresh("row_mark", docs.columns), fresh("secret_spans", docs.columns)
    marked = docs.withColumn(mark, F.xxhash64(F.lit(0), F.col("doc_id").isNull(), "doc_id", "text"))
    judged = _judged(marked.withColumn("doc_id", F.col(mark)), owner, repo, max_owners, max_repos)
    judged = judged.where(F.size("spans") > 0).groupBy("doc_id").agg(F.first("spans").alias(held))
    judged = stage(judged.withColumnRenamed("doc_id", mark), "secret-spans")
    if judged.count() <= 1 << 20:
        judged = F.broadcast(judged)
    joined = marked.join(judged, mark, "left")

    def step(state: Column, span: Column) -> Column:
        begins = F.greatest(state["at"], span["start"])
        before = F.substring(F.col("text"), state["at"] + 1, begins - state["at"])
        new = F.when(span["start"] >= state["at"], F.concat(before, F.lit(MARK))).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], span["finish"]).alias("at"), F.concat(state["out"], new).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cleaned = F.aggregate(
        F.array_sort(held), start, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.lit(2**31 - 1)))
    )
    text = F.when(F.col(held).isNull(), F.col("text")).otherwise(cleaned)
    return joined.select(*(text.alias(c) if c == "text" else F.col(quoted(c)) for c in docs.columns))
