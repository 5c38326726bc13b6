"""Personal data by column expressions only: fixed formats, and candidates that boosted trees select.

Generators of high recall propose spans that may overlap: loose mail addresses, long numbers
and dotted quads. The strict spans of all texts, rewritten as loose forms where they stand, are what
gradient-boosted trees learn from, against candidates without any word for personal data; format
and context are the features, no check of a strict format is. Examples with equal features become one
weighted row before the fit. A threshold with a
wanted precision on a calibration part selects further spans. The fitted trees become a
column expression, so that all spans of a text are found and judged inside its row: there is
no join and no Python on the executors, and no text is shuffled.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.arrow_text import free_name
from quillmark.sources.staging import stage

KINDS = ("email", "ip", "card", "phone", "model")
_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"

# The formats. Possessive repeats and the look-behind change no match, they only keep the
# search linear: a match cannot start inside a run unless the one before ended there.
_MAIL_NAME = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]+"
EMAIL = _MAIL_NAME + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++"
IP = r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
# A shorter run of digits cannot be a card, and leaves the others as they are.
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Candidates, wider than the formats.
LOOSE_EMAIL = _MAIL_NAME + r"\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]+)++"
NUMBER = r"\+?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+"
LOOSE_IP = r"(?<![0-9.])[0-9]++(?:\.[0-9]+){3}+"

# Trees and their depth, and the precision that a threshold must reach.
TREES, DEPTH = 8, 3
LEAST_PRECISION = 0.98
LEAST_CANDIDATES = 20
_THRESHOLDS = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95)
_CONTEXT = 24
_BLOCK = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _before(values: Column, merge: Callable[[Column, Column], Column], start: Column) -> Column:
    """For each of the values what ``merge`` makes of all before it, beginning with ``start``.

    An array that grows by one is copied each time, so the values are taken in blocks of ``_BLOCK``: the blocks'
    results first, then the inside of each. That is linear up to about a million values.
    """

    def scan(items: Column, first: Column) -> Column:
        return F.aggregate(items, F.array(first), lambda made, v: F.array_append(made, merge(F.element_at(made, -1), v)))

    def blocks(all_values: Column) -> Column:
        last = F.floor((F.size(all_values) - 1) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda j: F.slice(all_values, j * _BLOCK + 1, F.lit(_BLOCK)))

    def inside(cut: Column) -> Column:
        totals = F.transform(cut, lambda block: F.aggregate(block, start, merge))
        return _let(scan(totals, start), lambda firsts: F.flatten(F.transform(
            cut, lambda block, j: F.slice(scan(block, F.get(firsts, j)), F.lit(1), F.size(block)))))

    return F.when(F.size(values) > 0, _let(blocks(values), inside)).otherwise(F.slice(values, 1, 0))


def _found(text: Column, pattern: str, kind: int, needs: Column) -> Column:
    """All matches, leftmost first and without overlap, as spans in code points.

    Splitting at the matches gives the lengths between them, and so their places.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(hits, F.split(text, pattern, -1), lambda h, g: F.struct(h.alias("hit"), F.length(g).alias("gap")))

    def located(found: Column) -> Column:
        ends = _before(F.transform(found, lambda p: p["gap"] + F.length(p["hit"])), lambda a, b: a + b, F.lit(0))
        return F.zip_with(found, ends, lambda p, before: F.struct(
            (before + p["gap"]).alias("start"), F.lit(kind).alias("kind"),
            (before + p["gap"] + F.length(p["hit"])).alias("end"), p["hit"].alias("value")))

    # The text behind the last match has none.
    matched = F.filter(pairs, lambda p: p["hit"].isNotNull())
    return F.when(needs & text.rlike(pattern), _let(matched, located)).otherwise(F.array().cast(_SPANS))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _low_parts(value: Column) -> Column:
    """Whether every part of a dotted quad is at most 255, leading zeros aside."""
    low = lambda part: F.coalesce(F.regexp_extract(part, r"^0*([0-9]{1,3})$", 1).try_cast("int") <= 255, F.lit(False))
    return F.forall(F.split(value, r"\."), low)


def _luhn(digits: Column) -> Column:
    """Whether a number passes the check of cards: from the right, every second digit counts double."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans of the strict formats: (start, kind, end, value), by kind and start."""
    has_digit = text.rlike("[0-9]")
    length = lambda s: F.length(_digits(s["value"]))
    return F.concat(
        _found(text, EMAIL, 0, F.contains(text, F.lit("@"))),
        F.filter(_found(text, IP, 1, has_digit & F.contains(text, F.lit("."))), lambda s: _low_parts(s["value"])),
        F.filter(_found(text, CARD, 2, has_digit), lambda s: length(s).between(12, 19) & _luhn(_digits(s["value"]))),
        F.filter(_found(text, PHONE, 3, F.contains(text, F.lit("+"))), lambda s: length(s).between(9, 15)),
    )


def candidate_spans(text: Column) -> Column:
    """Spans that may be personal data; they may overlap, and ``kind`` tells their generator."""
    has_digit = text.rlike("[0-9]")
    return F.concat(
        _found(text, LOOSE_EMAIL, 0, text.rlike(r"@|[(\[]at[)\]]")),
        _found(text, LOOSE_IP, 1, has_digit & F.contains(text, F.lit("."))),
        _found(text, NUMBER, 2, has_digit),
    )


def _count(value: Column, characters: str) -> Column:
    return F.length(value) - F.length(F.regexp_replace(value, characters, ""))


def _features(text: Column, span: Column) -> dict[str, Column]:
    """Format and context of a candidate, as numbers."""
    value = span["value"]
    begin = F.greatest(span["start"] - _CONTEXT, F.lit(0))
    before = F.lower(F.substring(text, begin + 1, span["start"] - begin))
    after = F.substring(text, span["end"] + 1, F.lit(2))
    flags = {
        "plus": F.startswith(value, F.lit("+")),
        "at_sign": F.contains(value, F.lit("@")),
        "written_at": value.rlike(r"[(\[](at|dot)[)\]]"),
        "says_mail": before.rlike("mail|contact|write"),
        "says_phone": before.rlike("phone|tel|call|mobile|fax|cell"),
        "says_card": before.rlike("card|visa|credit|payment|account"),
        "says_host": before.rlike("ip|host|server|addr"),
        "word_before": before.rlike("[A-Za-z0-9_]$"),
        "word_after": after.rlike("^[.-]?[A-Za-z0-9_]"),
        "ends_in_name": value.rlike(r"[A-Za-z]{2,}$"),
    }
    counts = {
        "kind": span["kind"], "length": F.length(value), "digits": _count(value, "[0-9]"),
        "letters": _count(value, "[A-Za-z]"), "blanks": _count(value, " "), "dots": _count(value, r"\."),
        "dashes": _count(value, "-"), "brackets": _count(value, "[()]"),
        "longest_part": F.array_max(F.transform(F.split(value, "[^0-9A-Za-z]+"), lambda part: F.length(part))),
    }
    return {k: v.cast("double") for k, v in counts.items()} | {k: v.cast("double") for k, v in flags.items()}


@dataclass
class SpanModel:
    """Fitted trees as nested choices, each ``(feature, limit, low, high)`` or a number; their weights; a threshold."""

    names: list[str]
    trees: list
    weights: list[float]
    threshold: float

    def probability(self, features: dict[str, Column]) -> Column:
        """The calibrated score as an expression."""

        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            name, limit, low, high = node
            return F.when(features[name] <= limit, value(low)).otherwise(value(high))

        margin = sum((F.lit(w) * value(t) for t, w in zip(self.trees, self.weights)), F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-2.0 * margin))


def _tree(node, names: list[str]):
    """A fitted tree as nested choices."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (names[split.featureIndex()], float(split.threshold()),
            _tree(node.leftChild(), names), _tree(node.rightChild(), names))


def _loose_forms(span: Column) -> Column:
    """The value of a strict span as people write it who do not want it found: no fixed format fits these."""
    value = span["value"]
    digits = _digits(value)
    groups = lambda sign: F.rtrim(F.regexp_replace(digits, "([0-9]{3,4})(?=[0-9]{2})", f"$1{sign}"))
    mail = F.array(
        F.replace(value, F.lit("@"), F.lit("(at)")), F.replace(value, F.lit("@"), F.lit(" [at] ")),
        F.replace(F.replace(value, F.lit("@"), F.lit(" (at) ")), F.lit("."), F.lit(" (dot) ")),
    )
    phone = F.array(F.substring(value, F.lit(2), F.length(value)), groups("-"), groups(" "), groups("."), digits)
    # A slip in the last digit fails the check.
    last = (F.substring(value, F.length(value), F.lit(1)).cast("int") + 1) % 10
    slip = F.concat(F.substring(value, F.lit(1), F.length(value) - 1), last.cast("string"))
    card = F.array(slip, groups("."), groups("-"))
    return F.when(span["kind"] == 0, mail).when(span["kind"] == 3, phone).when(span["kind"] == 2, card)


def _examples(texts: DataFrame) -> DataFrame:
    """``(text, key, label, span)``: candidates that are personal data, rewritten, and some that are none.

    Positive are the loose forms of strict spans, where they stand in their text: candidates that no fixed format
    has, as those are that the model is to judge. Negative are candidates that overlap no strict span and have
    no word for personal data before them; the others say nothing and take no part.
    """
    text = F.col("text")
    listed = texts.select("text", F.xxhash64("text").alias("key"), base_spans(text).alias("base"), candidate_spans(text).alias("found"))
    strict = listed.where(F.size("base") > 0).select("key", "text", F.explode("base").alias("span")).where("span.kind <> 1")
    begin = F.greatest(F.col("span.start") - 2 * _CONTEXT, F.lit(0))
    forms = strict.select(
        "key", F.substring(text, begin + 1, F.col("span.start") - begin).alias("before"),
        F.substring(text, F.col("span.end") + 1, F.lit(_CONTEXT)).alias("after"), F.explode(_loose_forms(F.col("span"))).alias("form"),
    )
    written = forms.select("key", F.length("before").alias("at"), F.concat("before", "form", "after").alias("text"),
                           base_spans(F.concat("before", "form", "after")).alias("base"))
    loose = written.select("key", "text", "at", "base", F.explode(candidate_spans(text)).alias("span"))
    loose = loose.where((F.col("span.start") == F.col("at")) & ~F.exists("base", lambda b: b["start"] == F.col("at")))
    rest = listed.where(F.size("found") > 0).select("key", "text", F.explode(_free("found", "base")).alias("span"))
    features = _features(text, F.col("span"))
    says = sum((features[name] for name in features if name.startswith("says_")), F.lit(0.0))
    return loose.select("text", "key", F.lit(1.0).alias("label"), "span").unionByName(
        rest.where(says == 0).select("text", "key", F.lit(0.0).alias("label"), "span"))


def fit(docs: DataFrame) -> SpanModel | None:
    """Trees from the candidates of all documents.

    None if the texts have too few examples of either label, or no threshold is precise enough on texts that took
    no part in the fit.
    """
    texts = docs.select("text").where("text is not null")
    features = _features(F.col("text"), F.col("span"))
    names = list(features)
    part = F.pmod(F.xxhash64(F.lit("part"), "key"), F.lit(3))
    examples = _examples(texts).select("label", part.alias("part"), *[v.alias(k) for k, v in features.items()])
    # Examples that look alike are one row with their number, so the fit is over kinds of examples.
    rows = stage(examples.groupBy("label", "part", *names).agg(F.count("*").cast("double").alias("n")), "candidates")
    fitted, held = rows.where("part <> 0"), rows.where("part = 0")
    label, n = F.col("label"), F.col("n")
    positive, negative = fitted.agg(F.sum(label * n), F.sum((1 - label) * n)).first()
    if min(positive or 0, negative or 0) < LEAST_CANDIDATES:
        return None
    # Both labels weigh alike, however rare one is.
    weight = F.when(F.col("label") == 1, 1.0 / positive).otherwise(1.0 / negative) * n * (positive + negative) / 2
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(fitted.withColumn("weight", weight))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, maxBins=32, weightCol="weight").fit(vectors)
    made = SpanModel(names, [_tree(t._java_obj.rootNode(), names) for t in model.trees], list(model.treeWeights), 2.0)
    scored = held.select("label", "n", made.probability({n: F.col(n) for n in names}).alias("p"))
    sums: list[Column] = []
    for limit in _THRESHOLDS:
        above = F.col("p") >= limit
        sums += [F.sum(F.when(above, label * n)), F.sum(F.when(above, n))]
    totals = scored.agg(*sums).first()
    for limit, right, chosen in zip(_THRESHOLDS, totals[::2], totals[1::2]):
        if chosen and right / chosen >= LEAST_PRECISION:
            made.threshold = limit
            return made
    return None


def _free(found: Column | str, base: Column | str) -> Column:
    """The candidates that overlap no base span, by one sweep over both in order of their starts.

    A candidate is free if all base spans before it end by its start and the next one starts at its end or later.
    """
    span = lambda strict: lambda s: F.struct(
        s["start"].alias("start"), F.lit(strict).alias("loose"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))
    merged = F.array_sort(F.concat(F.transform(base, span(0)), F.transform(found, span(1))))
    far = F.lit(1 << 30)

    def sweep(order: Column) -> Column:
        ends = _before(F.transform(order, lambda s: F.when(s["loose"] == 0, s["end"]).otherwise(0)), lambda a, b: F.greatest(a, b), F.lit(0))
        starts = F.reverse(_before(
            F.reverse(F.transform(order, lambda s: F.when(s["loose"] == 0, s["start"]).otherwise(far))), lambda a, b: F.least(a, b), far))
        bounds = F.arrays_zip(order.alias("span"), ends.alias("behind"), starts.alias("ahead"))
        free = F.filter(bounds, lambda x: (x["span"]["loose"] == 1) & (x["behind"] <= x["span"]["start"])
                        & (x["ahead"] >= x["span"]["end"]))
        return F.transform(free, lambda x: F.struct(x["span"]["start"].alias("start"), x["span"]["kind"].alias("kind"),
                                                    x["span"]["end"].alias("end"), x["span"]["value"].alias("value")))

    return _let(merged, sweep)


def _judged(text: Column, base: Column, found: Column, model: SpanModel | None) -> Column:
    """All spans: the base ones, and the candidates that the model selects where no base span is."""
    if model is None:
        return base
    chosen = F.filter(_free(found, base), lambda s: model.probability(_features(text, s)) >= model.threshold)
    added = F.transform(chosen, lambda s: F.struct(
        s["start"].alias("start"), F.lit(4).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    return F.concat(base, added)


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans by start and kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    short = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(short), one), ",")


def _with_spans(docs: DataFrame, model: SpanModel | None) -> tuple[DataFrame, str, str]:
    """``docs`` with its base spans and all its spans, and the names of these columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base, spans = free_name(docs, "base"), free_name(docs, "spans")
    found = docs.withColumn(base, base_spans(text))
    return found.withColumn(spans, _judged(text, F.col(base), candidate_spans(text), model)), base, spans


def find_personal_data(docs: DataFrame, model: SpanModel | None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)``, one row for each row of ``docs``.

    ``spans`` lists ``kind:start:end`` of all spans by start and then kind, in code points with
    the end excluded; ``base_sha256`` is the digest of the same list without the spans that
    the model adds. Null and empty texts have none. Texts are searched whole.
    """
    found, base, spans = _with_spans(docs.select("doc_id", "text"), model)

    def count(kind: int) -> Column:
        return F.size(F.filter(F.col(base), lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(4)]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col(base)), 256).alias("base_sha256"),
                        _listed(F.col(spans)).alias("spans"))


def redact(docs: DataFrame, model: SpanModel | None, mark: str = "[personal]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; spans that overlap are replaced together. Null texts stay null."""
    found, base, spans = _with_spans(docs, model)
    text = F.col("text")
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("made"))

    def cut(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        fresh = span["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["made"], gap, F.lit(mark))).otherwise(state["made"]).alias("made"),
        )

    rest = lambda s: F.concat(s["made"], F.substring(text, s["at"] + 1, F.length(text)))
    cleaned = F.when(F.size(spans) > 0, F.aggregate(ordered, start, cut, rest)).otherwise(text)
    return found.withColumn("text", cleaned).select(*docs.columns)
