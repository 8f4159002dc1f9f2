"""Personal data: rule-checked base spans, and further spans that boosted trees select among candidates.

Generators of high recall propose overlapping candidate spans. Gradient-boosted trees score each by its
format and by the text before and after it. They learn, on a bounded sample of each kind's distinct matches,
which candidates the rules confirm; the threshold of each kind is set on all spans that the trees did not
learn from. What is above it and apart from all base spans is added. Base spans always stay.

DataFrame and SQL functions, and the trees of Spark's own library, which are functions of a DataFrame too.
Work on a text happens in its row. Only spans are shuffled, by document.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.llm.common import free_names, numbered, quoted, settled, text_or_empty
from tidemill.session import stored

#: The kinds in their order, and the form of the base spans. Possessive repeats and the look
#: behind (or at the end of the last match) find the same matches without trying again inside a run.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind's forms to be looked for.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+"}
#: Candidate forms, wider than the base: spelled-out marks, other separators, checks that fail.
CANDIDATES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,3}(?:[.,][0-9]{1,3}){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7})(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9+])[+(0-9](?:[\x20()./-]{0,2}[0-9]){6,14}(?![0-9])",
}
CANDIDATE_NEEDS = {"email": r"@|\(at\)|\[at\]", "ip": "[0-9]", "card": "[0-9]{2}", "phone": "[0-9]"}
HINTS = {
    "email": r"mail|contact|write|schreib|escrib|écri",
    "ip": r"\bip\b|host|server|address|adress|direcci",
    "card": r"card|visa|credit|karte|tarjeta|carte|pay",
    "phone": r"phone|tel|call|mobile|anruf|llam|appel",
}
#: Bounds of what is learnt from: distinct matches of each kind, of smallest hash. Hashes have so many places.
SAMPLE_ROWS, PLACES = 20_000, 1 << 14
TREES, DEPTH, SEED = 12, 3, 11
#: Share of right ones that a kind's threshold must reach on the unseen part, among this many at least. Scores
#: are counted in so many steps; as a power of two it makes each step's end an exact number.
PRECISION, LEAST_UNSEEN, STEPS = 0.98, 10, 1 << 14
AROUND = 24

_SPAN = "array<struct<kind: int, start: int, end: int, found: string, before: string, after: string, base: boolean>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    figures = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), lambda c: c.cast("int"))
    sums = F.aggregate(
        F.transform(figures, lambda n, i: F.when(i % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n)), F.lit(0), lambda a, n: a + n
    )
    return sums % 10 == 0


def _confirmed(kind: str, found: Column) -> Column:
    """The checks of a kind on a match of its base form."""
    if kind == "ip":
        return ~F.exists(F.split(found, r"\."), lambda part: ~part.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    count = F.length(_digits(found))
    if kind == "card":
        return F.when(count.between(12, 19), luhn(_digits(found))).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(9, 15)
    return F.lit(True)


def _spans(text: Column, kind: str, form: str, needs: str, base: bool) -> Column:
    """The matches of a form with their places in code points: gaps and matches follow each other."""
    gaps, found = F.split(text, form, -1), F.regexp_extract_all(text, F.lit(form), F.lit(0))
    after = F.slice(F.transform(gaps, lambda g: F.left(g, F.lit(AROUND))), 2, F.size(gaps))
    steps = F.transform(F.arrays_zip(gaps.alias("gap"), found.alias("found"), after.alias("after")), lambda x: F.struct(x["gap"].alias("gap"), x["found"].alias("found"), x["after"].alias("after")))
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(_SPAN).alias("out"))

    def walk(state: Column, step: Column) -> Column:
        begin = state["at"] + F.length(step["gap"])
        end = begin + F.coalesce(F.length(step["found"]), F.lit(0))
        one = F.array(F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), begin.alias("start"), end.alias("end"), step["found"].alias("found"),
            F.right(step["gap"], F.lit(AROUND)).alias("before"), step["after"].alias("after"), F.lit(base).alias("base"),
        )).cast(_SPAN)
        good = step["found"].isNotNull() & (_confirmed(kind, step["found"]) if base else F.lit(True))
        return F.struct(end.alias("at"), F.when(good, F.concat(F.coalesce(state["out"], F.array().cast(_SPAN)), one)).otherwise(state["out"]).alias("out"))

    none = F.array().cast(_SPAN)
    return F.when(text.rlike(needs), F.coalesce(F.aggregate(steps, start, walk, lambda s: s["out"]), none)).otherwise(none)


def proposed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``rid, kind, start, end, base``, a hash of the ``match`` and the features of every base span and every
    candidate. A candidate that is a base span is that span."""
    body = text_or_empty(F.col("text"))
    lists = [_spans(body, k, BASE[k], NEEDS[k], True) for k in KINDS] + [_spans(body, k, CANDIDATES[k], CANDIDATE_NEEDS[k], False) for k in KINDS]
    rows = numbered(docs.select("doc_id", F.col(text).alias("text")))
    spans = rows.select("rid", F.explode(F.concat(*lists)).alias("s")).select("rid", "s.*")
    spans = spans.groupBy("rid", "kind", "start", "end").agg(
        F.max("base").alias("base"), *(F.max(c).alias(c) for c in ("found", "before", "after"))
    )
    count = {
        "n_digits": "[^0-9]", "n_letters": r"[^\p{L}]", "n_dots": "[^.]", "n_spaces": r"[^\x20]", "n_dashes": "[^-/]", "n_marks": r"[^()\[\]]", "n_colons": "[^:]",
        "n_plus": "[^+]", "n_at": "[^@]",
    }
    hint = F.lit(False)
    for i, k in enumerate(KINDS):
        hint = hint | ((F.col("kind") == i) & F.lower("before").rlike(HINTS[k]))
    return spans.select(
        "rid", "kind", "start", "end", "base", F.xxhash64("found").alias("match"),
        *((F.col("kind") == i).cast("double").alias(f"is_{k}") for i, k in enumerate(KINDS)),
        F.length("found").cast("double").alias("n_chars"),
        *(F.length(F.regexp_replace("found", other, "")).cast("double").alias(name) for name, other in count.items()),
        hint.cast("double").alias("hint"),
        F.col("before").rlike(r"[\p{L}0-9]$").cast("double").alias("joined_before"),
        F.coalesce(F.col("after"), F.lit("")).rlike(r"^[\p{L}0-9]").cast("double").alias("joined_after"),
        F.col("before").rlike("[=\"':#]\\s*$").cast("double").alias("assigned"),
        F.length(F.regexp_extract("found", "^[^0-9]*([0-9]*)", 1)).cast("double").alias("first_digits"),
        F.length(F.regexp_extract("found", "([0-9]*)[^0-9]*$", 1)).cast("double").alias("last_digits"),
    )


def added(spans: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``rid, kind, start, end`` of the candidates that the trees select.

    ``spans`` is a stored table from :func:`proposed`. The trees learn from up to ``rows`` distinct matches of
    each kind. Each kind's threshold covers all spans with other matches. A kind whose threshold can't be set
    adds nothing, nor does a sample that lacks confirmed or other candidates.
    """
    empty = spans.where("false").select("rid", "kind", "start", "end")
    names = [c for c in spans.columns if c not in ("rid", "kind", "start", "end", "match", "base")]
    score = VectorAssembler(inputCols=names, outputCol="features").transform
    share = vector_to_array("probability")[1].alias("share")
    place = F.pmod(F.shiftright("match", 8), F.lit(PLACES))
    learnt = F.lit(False)
    for kind, last in _sampled(spans, place, rows).items():
        learnt = learnt | ((F.col("kind") == kind) & (place <= last))
    learnt = learnt & (F.pmod("match", F.lit(4)) != 0)
    # of equal matches the one of smallest hash: a text that many rows share is learnt once
    mark = F.xxhash64("rid", "start", "end")
    first = spans.where(learnt).groupBy("kind", "match").agg(F.min(mark).alias("mark"))
    sample = spans.where(learnt).withColumn("mark", mark).join(first, ["kind", "match", "mark"])
    sample = sample.dropDuplicates(["kind", "match", "mark"]).withColumn("label", F.col("base").cast("double"))
    sample = stored(sample.repartition(1).sortWithinPartitions("kind", "match"), "pii-sample")
    if sample.select("label").distinct().count() < 2:
        return empty
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(score(sample))
    scored = model.transform(score(spans.withColumn("learnt", learnt))).select("rid", "kind", "start", "end", "base", "learnt", share)
    scored = stored(scored, "pii-scored")
    chosen = F.lit(False)
    for kind, least in _thresholds(scored.where("not learnt").select("kind", F.col("base").cast("double").alias("label"), "share")).items():
        chosen = chosen | ((F.col("kind") == kind) & (F.col("share") >= least))
    return scored.where(~F.col("base") & chosen).select("rid", "kind", "start", "end")


def _sampled(spans: DataFrame, place: Column, rows: int) -> dict[int, int]:
    """By kind, the last place of hashes up to which there are at most ``rows`` distinct matches to learn from
    (the first place in any case)."""
    usable = spans.where(F.pmod("match", F.lit(4)) != 0).select("kind", "match").distinct()
    found: dict[int, int] = {}
    held: dict[int, int] = {}
    for row in usable.groupBy("kind", place.alias("place")).agg(F.count("*").alias("n")).orderBy("kind", "place").collect():
        held[row["kind"]] = held.get(row["kind"], 0) + row["n"]
        if row["kind"] not in found or held[row["kind"]] <= rows:
            found[row["kind"]] = row["place"]
    return found


def _thresholds(rows: DataFrame) -> dict[int, float]:
    """By kind, the smallest score from which on candidates are confirmed often enough. ``rows`` are all spans
    that the trees did not learn from; only their counts by steps of the score are gathered."""
    found: dict[int, float] = {}
    held: dict[int, tuple[float, int]] = {}
    step = F.floor(F.col("share") * STEPS).cast("int")
    sums = rows.groupBy("kind", step.alias("step")).agg(F.sum("label").alias("right"), F.count("*").alias("n"))
    for row in sums.orderBy("kind", F.col("step").desc()).collect():
        right, n = held.get(row["kind"], (0.0, 0))
        right, n = right + row["right"], n + row["n"]
        held[row["kind"]] = right, n
        if right >= PRECISION * n and n >= LEAST_UNSEEN:
            found[row["kind"]] = max(row["step"] / STEPS, 0.5)
    return found


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``rid, doc_id`` and ``spans``, an array of ``start, kind, end, base``
    in this order. Null texts are empty. Ends are exclusive; places count code points.

    An added span overlaps no base span, and of overlapping added spans the first and then longest stays.
    """
    spans = stored(proposed(docs, text), "pii")
    more = stored(added(spans), "pii-added")
    both = spans.where("base").select("rid", "kind", "start", "end", F.lit(True).alias("base")).unionByName(more.withColumn("base", F.lit(False)))
    order = W.partitionBy("rid").orderBy("start", F.col("base").desc(), F.col("end").desc(), "kind")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(1, W.unboundedFollowing)
    apart = both.withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0))).withColumn(
        "next_base", F.min(F.when(F.col("base"), F.col("start"))).over(after)
    )
    kept = apart.where(F.col("base") | ((F.col("reached") <= F.col("start")) & (F.coalesce("next_base", "end") >= F.col("end"))))
    lists = kept.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "base"))).alias("spans"))
    rows = numbered(docs.select("doc_id", F.col(text).alias("text"))).select("rid", "doc_id")
    return rows.join(lists, "rid", "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start: int, kind: int, end: int, base: boolean>>")))


def redacted(docs: DataFrame, text: str = "text", mark: str = "[%s]") -> DataFrame:
    """The rows of ``docs`` with each span of ``text`` replaced by its kind, as in ``[email]``.

    Of spans that overlap each other, the text from the first begin to the last end goes, under the first's kind.
    """
    docs = settled(docs)
    rid, own = free_names(docs, "rid", "spans")
    spans = personal_data(docs, text).where(F.size("spans") > 0).select(F.col("rid").alias(rid), F.col("spans").alias(own))
    body = F.col(text)
    names = F.array(*(F.lit(mark % k) for k in KINDS))

    def walk(state: Column, span: Column) -> Column:
        apart = span["start"] >= state["at"]
        gap = F.substring(body, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(state["out"], gap, F.element_at(names, span["kind"] + 1))).otherwise(state["out"]).alias("out"),
        )

    clean = F.aggregate(own, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), walk, lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.length(body))))
    rows = numbered(docs, rid).join(spans, rid, "left").withColumn(text, F.when(F.col(own).isNull(), body).otherwise(clean))
    return rows.select(*map(quoted, docs.columns))
