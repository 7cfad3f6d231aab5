"""Licences of files: sparse TF-IDF cosine of lines, paragraphs and licence files to templates, then the
nearest directory's licence. DataFrame functions only.

Document frequencies of all terms are counted over the whole corpus; a term weighs its number in the unit
times log((1 + files) / (1 + frequency)) + 1. Units are the lines of every file, its paragraphs of
several lines (headers among them) and, for licence files, the whole text. Two filters, both exact, come
before any unit is weighed:

- a unit whose cosine reaches t shares terms with t^2 of the template's squared length, so it has at least
  one of the template's heaviest terms, as many as weigh more than 1 - t^2 of it (its keys). Files, then
  their units, without any template's key leave.
- the shared terms of the others are joined with the templates and must make up those t^2.

What is left is made distinct, so a statement that very many files repeat is weighed once, and its terms
are joined with their frequencies. A file's own licence is that of its best unit (ties: the template's
name). A directory's licence is that of the licence files in it (the best, ties by path). Every other file
without an own licence takes that of the nearest directory above it that has one: worked out once per
directory, by a join of its ancestors' paths, and then joined to the files.

Templates are a small table: their terms are gathered and sent to all tasks. A licence may have several.

Nulls: a null text has no units, a null path no directory. Repeated rows are judged one by one. Other
columns are ignored. Empty tables give empty results; without templates nothing has a licence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.session import stage

THRESHOLD = 0.75
BROADCAST_ROWS = 1 << 18  # terms or statements sent to all tasks at most; more are joined by a shuffle

# What lies between two terms: anything but ASCII letters, digits and ``.+-``, with stops in front of it.
_BREAK = r"[.+-]*[^a-z0-9.+-]+|[.+-]+$"
_PARAGRAPHS = r"\n[ \t\r]*\n"


def term_list(text: Column) -> Column:
    """Terms: runs of ASCII letters, digits and ``.+-``, lower-cased, without closing stops."""
    return F.array_remove(F.split(F.lower(text), _BREAK, -1), "")


def _few(frame: DataFrame) -> DataFrame:
    """The (staged) frame, to be sent to all tasks if it is small."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def _weights(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """(term, weight) of all terms of the corpus and the templates."""
    held = docs.select(F.explode(F.array_distinct(term_list(F.col("text")))).alias("term"), F.lit(1).alias("one"))
    said = templates.select(F.explode(F.array_distinct(term_list(F.col("text")))).alias("term"), F.lit(0).alias("one"))
    counted = held.unionByName(said).groupBy("term").agg(F.sum("one").alias("n"))
    weight = F.log(F.lit(1.0 + docs.count()) / (1 + F.col("n"))) + 1
    return stage(counted.select("term", weight.alias("weight")), "license-weights")


def _counted(units: DataFrame, by: str) -> DataFrame:
    """(by, term, tf): how often each term is in the ``terms`` of each unit."""
    return units.select(by, F.explode("terms").alias("term")).groupBy(by, "term").agg(F.count(F.lit(1)).alias("tf"))


def _vectors(templates: DataFrame, weights: DataFrame) -> DataFrame:
    """(template, license, term, part, before, total): the template's terms by falling weight, with the squared
    length of those before each and of all."""
    known = templates.where("text is not null").select("license", "text").distinct()
    known = known.select(F.sha2(F.concat_ws("\x00", "license", "text"), 256).alias("template"), "license", term_list(F.col("text")).alias("terms"))
    parts = _counted(known, "template").join(weights, "term").select("template", "term", (F.col("tf") * F.col("weight")).alias("part"))
    square = F.col("part") * F.col("part")
    whole = Window.partitionBy("template")
    ahead = whole.orderBy(F.desc("part"), "term").rowsBetween(Window.unboundedPreceding, -1)
    sized = parts.select("template", "term", "part", F.coalesce(F.sum(square).over(ahead), F.lit(0.0)).alias("before"), F.sum(square).over(whole).alias("total"))
    return stage(sized.join(known.select("template", "license"), "template"), "license-vectors")


def _units(text: Column, is_license: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    paragraphs = F.filter(F.split(text, _PARAGRAPHS, -1), lambda p: F.contains(p, F.lit("\n")))
    several = F.when(F.contains(text, F.lit("\n")), F.concat(F.split(text, "\n", -1), paragraphs)).otherwise(F.array(text))
    return F.when(is_license, F.concat(several, F.array(text))).otherwise(several)


def own_licenses(files: DataFrame, templates: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """(key, license, score) of the files (key, text, is_license) with a unit like a template."""
    weights = _weights(files, templates)
    known = _vectors(templates, weights)
    # a little less than the threshold, so that rounding drops nothing
    share = threshold * threshold - 1e-6
    keys = sorted({r.term for r in known.where(F.col("before") <= (1 - share) * F.col("total")).select("term").distinct().collect()})
    literal = F.lit(keys) if keys else F.array().cast("array<string>")

    near = files.where(F.arrays_overlap(term_list(F.col("text")), literal))
    units = near.select("key", F.explode(F.array_distinct(_units(F.col("text"), F.col("is_license")))).alias("unit"))
    units = units.select("key", term_list(F.col("unit")).alias("terms")).where(F.arrays_overlap("terms", literal))
    units = stage(units.select("key", F.sha2(F.array_join("terms", " "), 256).alias("unit"), "terms").distinct(), "license-units")

    statements = units.groupBy("unit").agg(F.first("terms").alias("terms"))
    vectors = F.broadcast(known.select("template", "license", "term", "part", "total"))
    shared = statements.select("unit", F.explode(F.array_distinct("terms")).alias("term")).join(vectors, "term")
    hopeful = shared.groupBy("unit", "template").agg(F.sum(F.col("part") * F.col("part")).alias("both"), F.first("total").alias("total"))
    hopeful = stage(hopeful.where(F.col("both") >= share * F.col("total")).select("unit").distinct(), "license-hopeful")
    counts = stage(_counted(statements.join(_few(hopeful), "unit"), "unit"), "license-counts")
    asked = stage(counts.select("term").distinct(), "license-terms")
    own = counts.join(_few(stage(weights.join(_few(asked), "term"), "license-asked")), "term")
    own = stage(own.select("unit", "term", (F.col("tf") * F.col("weight")).alias("own")), "license-parts")
    norms = own.groupBy("unit").agg(F.sum(F.col("own") * F.col("own")).alias("length"))
    dots = own.join(vectors, "term").groupBy("unit", "template").agg(
        F.sum(F.col("own") * F.col("part")).alias("dot"), F.first("license").alias("license"), F.first("total").alias("total")
    )
    score = F.round(F.col("dot") / F.sqrt(F.col("length") * F.col("total")), 6)
    scored = dots.join(norms, "unit").select("unit", "license", score.alias("score")).where(F.col("score") >= threshold)
    ranked = scored.select("unit", F.struct((-F.col("score")).alias("rank"), "license").alias("best")).groupBy("unit").agg(F.min("best").alias("best"))
    best = units.select("key", "unit").join(_few(stage(ranked, "license-best")), "unit").groupBy("key").agg(F.min("best").alias("best"))
    return best.select("key", F.col("best.license").alias("license"), (-F.col("best.rank")).alias("score"))


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def _inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, near, license) of each directory with a licence in it or above it."""
    parts = F.split("dir", "/", -1)
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    spread = directories.select("dir", F.explode(F.array_distinct(above)).alias("near"))
    met = spread.join(licensed, "near")
    return met.groupBy("dir").agg(F.max(F.struct(F.length("near").alias("long"), "near", "license")).alias("x")).select(
        "dir", F.col("x.near").alias("near"), F.col("x.license").alias("license")
    )


_RESULT = ("path", "license", "score", "origin", "license_dir")


def scan(files: DataFrame, templates: DataFrame, *, threshold: float = THRESHOLD, extra: list[str] | None = None) -> DataFrame:
    """Licence of each file: (path, license, score, origin, license_dir) and the ``extra`` columns, of which one
    named like a result comes back with ``file_`` in front.

    ``files`` has path, text and is_license; ``origin`` is own, inherited or none.
    """
    carried = F.struct(F.lit(0).alias("row"), *(F.col(name).alias(f"{k}:{name}") for k, name in enumerate(extra or []))).alias("extra")
    files = files.select("path", "text", F.coalesce("is_license", F.lit(False)).alias("is_license"), carried)
    # rows with one key have one result: it is a hash of all that is judged
    judged = F.concat_ws("\x00", F.col("is_license").cast("string"), F.coalesce("text", F.lit("\x01")))
    keyed = files.withColumn("key", F.sha2(judged, 256))
    own = stage(own_licenses(keyed.select("key", "text", "is_license"), templates, threshold=threshold), "own-licenses")
    table = keyed.select("key", "path", "is_license", "extra", _directory(F.col("path")).alias("dir"))
    said = stage(table.join(_few(own), "key", "left"), "license-said")
    from_files = said.where("is_license and license is not null and path is not null").groupBy(F.col("dir").alias("near")).agg(
        F.min(F.struct((-F.col("score")).alias("rank"), "path", "license")).alias("x")
    ).select("near", F.col("x.license").alias("license"))
    directories = said.select("dir").where("dir is not null").distinct()
    found = stage(_inherited(directories, from_files), "license-dirs").select("dir", "near", F.col("license").alias("dir_license"))
    whole = said.join(_few(found), "dir", "left")
    return whole.select(
        "path", F.coalesce("license", "dir_license").alias("license"), "score",
        F.when(F.col("license").isNotNull(), "own").when(F.col("dir_license").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("license").isNull(), F.col("near")).alias("license_dir"),
        *(F.col(f"extra.`{k}:{name}`").alias(f"file_{name}" if name in _RESULT else name) for k, name in enumerate(extra or [])),
    )
