"""Personal data by boosted trees over candidate spans.

High-recall generators propose spans that may overlap: the strict base formats,
spelled-out addresses, number runs, dotted numbers. Boosted trees (MLlib, fitted
here) score each proposal from its format and context; its class is whether it
holds a valid base span, which the trees must tell without the base formats. The
documents' addresses and phone numbers also teach in disguise, where they stand:
spelled out (``a (at) b (dot) c``) or without the country, forms that no base
format finds. Every document teaches, three quarters (by a hash) the trees and the
rest the thresholds: proposals with equal features are one row with a weight. A
threshold per generator is calibrated on the part that fitting did not see. The
texts are scanned once, for the fit and the result. Base spans always stay; proposals that overlap none and pass their
threshold are added, of two that overlap the one with the better score. Scoring is
a SQL expression built from the trees; built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of
from .spans import listed, match_spans, tagged

TREES, DEPTH = 10, 3
#: Precision that the calibrated threshold must reach on the held-out part.
PRECISION = 0.98

#: The base formats, in listing order. Possessive repeats and the
#: starts (after the last match, or not inside a run) keep the search linear.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
         r"(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

#: The high-recall generators.
GENERATORS = (
    ("spelled_email", r"[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|@)\x20?[A-Za-z0-9-]{1,63}"
                      r"(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]{2,63}){1,4}+"),
    ("number_run", r"(?:\+|\()?[0-9](?:[\x20().-]{0,2}[0-9]){6,30}+"),
    ("dotted", r"[0-9]{1,5}(?:[.:][0-9]{1,5}){3,7}+"),
)
CONTEXT = 24
#: Words that announce personal data.
CUES = r"(?i)(phone|call|tel|mobil|card|visa|mail|contact|ssn|passport|iban|address|\bip\b|@)"


#: A spelled address, the end of a sentence, and separated numbers that
#: are no phone numbers: card and IP formats that fail their checks, decimals, dates.
SPELLED, SENTENCE = r"[(\[](?:at|dot)[)\]]", r"[^\x20]\.\x20"
NO_PHONE = (r"^(?:[0-9](?:[\x20-]?[0-9]){11,}|[0-9]+(?:\.[0-9]+){3,}|[0-9]+\.[0-9]+|"
            r"(?:19|20)[0-9]{2}([.-])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])(?:[^0-9].*)?)$")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def base_spans(text: Column) -> list[Column]:
    """The valid spans of each base kind."""
    small = r"^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})$"
    checks = (
        lambda s: F.lit(True),
        lambda s: F.forall(F.split(s["value"], r"\.", -1),
                           lambda p: F.regexp_like(p, F.lit(small))),
        lambda s: F.length(_digits(s["value"])).between(12, 19)
        & _luhn(_digits(s["value"])),
        lambda s: F.length(_digits(s["value"])).between(9, 15))
    return [F.filter(match_spans(text, p), ok)
            for p, ok in zip((EMAIL, IP, CARD, PHONE), checks, strict=True)]


def _count(value: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{chars}]", "")).cast("double")


def features(text: Column, span: Column, generator: int) -> list[Column]:
    """Format and context of a proposal, as doubles."""
    value = span["value"]
    before = F.substring(text, F.greatest(span["start"] - CONTEXT + 1, F.lit(1)),
                         F.least(span["start"], F.lit(CONTEXT)))
    after = F.substring(text, span["end"] + 1, F.lit(2))
    yes = lambda c: c.cast("double")
    return [
        F.lit(float(generator)), F.length(value).cast("double"), _count(value, "0-9"),
        _count(value, "A-Za-z"), _count(value, "."), _count(value, r"\x20-"),
        _count(value, "()"), yes(F.startswith(value, F.lit("+"))), yes(F.contains(value, F.lit("@"))),
        yes(F.regexp_like(value, F.lit("(?i)[(\\[](at|dot)"))),
        F.size(F.array_distinct(F.split(_digits(value), ""))).cast("double"),
        F.length(F.element_at(F.split(value, "[^0-9]", -1), 1)).cast("double"),
        yes(F.regexp_like(before, F.lit(r"[A-Za-z0-9.:+-]$"))),
        yes(F.regexp_like(after, F.lit(r"^[A-Za-z0-9:-]"))),
        yes(F.regexp_like(before, F.lit(CUES))),
        yes(_luhn(_digits(value)) & (F.length(_digits(value)) >= 12))]


N_FEATURES = 16


def proposals(text: Column, base: Column) -> Column:
    """Array of (start, end, kind, label, f): every generator's spans; label
    says whether the span overlaps a valid base span."""
    def proposal(number: int, kind: str):
        return lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
            .alias("label"),
            F.array(*features(text, s, number)).alias("f"))

    return F.concat(*[F.transform(match_spans(text, pattern), proposal(i, kind))
                      for i, (kind, pattern) in enumerate(GENERATORS)])


def undecided(kind: Column, value: Column) -> Column:
    """Whether a proposal without a base span may still be an address or phone
    number, in a form that the base formats do not know."""
    address = F.regexp_like(value, F.lit(SPELLED)) | ~F.regexp_like(value, F.lit(SENTENCE))
    number = (F.regexp_like(value, F.lit(r"[0-9][\x20().-]+[0-9]"))
              & ~F.startswith(value, F.lit("+")) & (F.length(_digits(value)) <= 14)
              & ~F.regexp_like(value, F.lit(NO_PHONE)))
    return F.when(kind == "spelled_email", address).when(kind == "number_run", number).otherwise(False)


def disguises(text: Column, emails: Column, phones: Column) -> Column:
    """Array of (text, start, end): every address and phone number written in
    other ways, in its own surroundings. A number that has no separators
    without its country is left out: nothing would tell it from any other."""
    def placed(span: Column, value: Column) -> Column:
        lead = F.least(span["start"], F.lit(CONTEXT))
        before = F.substring(text, span["start"] - lead + 1, lead)
        return F.struct(F.concat(before, value, F.substring(text, span["end"] + 1, F.lit(2)))
                        .alias("text"), lead.alias("start"), (lead + F.length(value)).alias("end"))

    def spelled(span: Column) -> Column:
        parts = F.split(span["value"], "@")
        return F.array(
            placed(span, F.concat_ws(" (at) ", parts[0], F.replace(parts[1], F.lit("."), F.lit(" (dot) ")))),
            placed(span, F.concat_ws("[at]", parts[0], F.replace(parts[1], F.lit("."), F.lit("[dot]")))),
            placed(span, F.concat_ws("(at)", parts[0], parts[1])))

    def national(span: Column) -> Column:
        return F.regexp_replace(span["value"], r"^\+[0-9]{1,3}[\x20.-]*", "")

    def local(span: Column) -> Column:
        plain = F.trim(F.regexp_replace(national(span), r"[\x20().-]+", " "))
        return F.array(placed(span, national(span)), placed(span, plain),
                       placed(span, F.replace(plain, F.lit(" "), F.lit("-"))))

    separated = F.filter(phones, lambda s: F.regexp_like(national(s), F.lit(r"[0-9][\x20().-]+[0-9]")))
    return F.flatten(F.concat(F.transform(emails, spelled), F.transform(separated, local)))


def _tree_score(node, f: Column) -> Column:
    """A fitted regression tree as nested conditions."""
    if node.numDescendants() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return (F.when(F.element_at(f, split.featureIndex() + 1) <= split.threshold(),
                   _tree_score(node.leftChild(), f))
            .otherwise(_tree_score(node.rightChild(), f)))


def _scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row, stored: id, key (a hash of id and text), email, ip, card and phone (its
    base spans), proposals, each also with whether it ``teaches``, and its disguises."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select("*", *[b.alias(k) for k, b in zip(KINDS, base_spans(F.col("text")), strict=True)])
    value = lambda p: F.substring(F.col("text"), p["start"] + 1, p["end"] - p["start"])
    found = F.transform(proposals(F.col("text"), F.concat(*KINDS)), lambda p: p.withField(
        "teaches", p["label"] | ~undecided(p["kind"], value(p))))
    return stored(rows.select(
        "id", F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("null")), "text").alias("key"),
        *[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k)
          for k in KINDS], found.alias("proposals"),
        disguises(F.col("text"), F.col("email"), F.col("phone")).alias("disguises")), "pii-scanned")


def _lessons(scanned: DataFrame) -> DataFrame:
    """(held, label, f, weight), stored: what all rows teach, equal features together.
    Rows that are equal (id and text) weigh as one; ``held`` are a quarter of the rows."""
    copies = scanned.groupBy("key").agg(F.count("*").alias("copies")).filter("copies > 1")
    rows = scanned.select("key", "proposals", "disguises").join(copies, "key", "left").select(
        (F.pmod("key", F.lit(4)) == 0).alias("held"), "proposals", "disguises",
        (F.lit(1.0) / F.coalesce("copies", F.lit(1))).alias("weight"))
    plain = (rows.select("held", "weight", F.explode("proposals").alias("p")).filter("p.teaches")
             .select("held", "weight", "p.label", "p.f"))
    other = (rows.select("held", "weight", F.explode("disguises").alias("d"))
             .select("held", "weight", F.explode(proposals(
                 F.col("d.text"), F.array(F.struct("d.start", "d.end")))).alias("p"))
             .filter("p.label").select("held", "weight", "p.label", "p.f"))
    return stored(plain.unionByName(other).groupBy("held", "label", "f")
                  .agg(F.sum("weight").alias("weight")), "pii-lessons")


def fit_scorer(docs: DataFrame, id_col: str, text_col: str):
    """(score function of a feature array, threshold per generator), or None where the
    documents have not both classes or no threshold reaches ``PRECISION``. All documents
    teach; equal rows teach as one."""
    return _fitted(_scanned(docs, id_col, text_col))


def _fitted(scanned: DataFrame):
    lessons = _lessons(scanned).withColumn("label", F.col("label").cast("double"))
    fit = lessons.filter("not held")
    if fit.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=[f"f{i}" for i in range(N_FEATURES)], outputCol="features").transform(
        fit.select("label", "weight", *[F.col("f")[i].alias(f"f{i}") for i in range(N_FEATURES)]))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, weightCol="weight").fit(
        rows.select("label", "weight", "features"))
    trees = [(t._call_java("rootNode"), w) for t, w in zip(model.trees, model.treeWeights,
                                                           strict=True)]

    def score(f: Column) -> Column:
        margin = reduce(lambda a, b: a + b, [_tree_score(t, f) * w for t, w in trees])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))

    # Calibration: the lowest score bin from which on precision holds.
    held = (lessons.filter("held")
            .groupBy(F.col("f")[0].alias("generator"), F.floor(score(F.col("f")) * 100).alias("bin"))
            .agg(F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n")))
    bins = held.collect()  # 101 rows a generator at most
    thresholds = {}
    for number, (kind, _) in enumerate(GENERATORS):
        good = n = 0
        for r in sorted((r for r in bins if r["generator"] == number), key=lambda r: -r["bin"]):
            good, n = good + r["good"], n + r["n"]
            if good < PRECISION * n:
                break
            thresholds[kind] = max(r["bin"] / 100, 0.5)
    return (score, thresholds) if thresholds else None


def without_overlaps(spans: Column) -> Column:
    """Of (start, end, kind, score), from left to right: of two spans that overlap the
    one with the better score, of equal ones the first."""
    def step(kept: Column, span: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        return (F.when(last.isNull() | (last["end"] <= span["start"]), F.concat(kept, F.array(span)))
                .when(span["score"] > last["score"],
                      F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(span)))
                .otherwise(kept))

    none = F.array().cast("array<struct<start:int,end:int,kind:string,score:double>>")
    return F.aggregate(F.array_sort(spans), none, step)


def scan_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``id_col``, n_email, n_ip, n_card, n_phone,
    base_sha256 (base spans) and spans (base and added ones), each span as
    ``kind:start:end`` in code points, by start, then kind as listed.

    Null text counts as empty. Repeated rows and null ids are scanned like any
    other row; spans of different kinds may overlap, both stay. Without both
    classes in the documents nothing is added, nor where a proposal overlaps a base
    span. Other columns are ignored; an empty
    table gives an empty result.
    """
    rows = _scanned(docs, id_col, text_col)
    scorer = _fitted(rows)
    base = F.concat(*[tagged(F.col(k), k, i) for i, k in enumerate(KINDS)])
    every = base
    if scorer:
        score, thresholds = scorer
        least = F.create_map(*[F.lit(x) for item in thresholds.items() for x in item])
        scored = F.transform(
            F.filter("proposals", lambda p: ~p["label"] & p["kind"].isin(list(thresholds))),
            lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"),
                               p["kind"].alias("kind"), score(p["f"]).alias("score")))
        added = without_overlaps(F.filter(scored, lambda p: p["score"] >= least[p["kind"]]))
        order = F.create_map(*[x for i, (k, _) in enumerate(GENERATORS)
                               for x in (F.lit(k), F.lit(len(KINDS) + i))])
        every = F.concat(base, F.transform(added, lambda p: F.struct(
            p["start"].alias("start"), order[p["kind"]].alias("order"), p["end"].alias("end"),
            p["kind"].alias("kind"))))
    return rows.select(
        F.col("id").alias(id_col), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(every).alias("spans"))
