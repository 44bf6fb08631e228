"""Personal data by candidate gradient boosting, in DataFrame expressions only.

Strict patterns give base spans, which always stay. Generators of high recall
propose further, possibly overlapping spans: spelled-out mail addresses, and
numbers in any grouping. A candidate is described by a few small whole numbers
of format and context that do not give the base format away: a leading plus is
not told, and mails are described as if written with @ and dots. Positive
examples are candidates that a base span touches, negative ones those on a
pattern match that failed its check (Luhn, digits, octets) and untouched ones
without a word of their kind before them. Untouched candidates after such a
word may be what the patterns miss and are no examples. The examples are
counted per distinct description and label, which is a table of bounded size;
boosted trees are fitted on these counts. A threshold is calibrated on
documents set apart: the lowest score from which on the wanted share of
examples is positive. Candidates above it that no base span touches are added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopflow.llm.common import Stored, hidden

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that a run of characters is scanned once: possessive, and never begun inside a run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What the generators propose.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?(?:@|\(at\)|\[at\]) ?| at )[A-Za-z0-9-]++(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?| dot )[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9])[+(]?[0-9](?:[ ().+/-]{0,3}[0-9]){6,24}+(?![0-9])",
}
#: Words before a candidate that say what it is.
CONTEXT = {1: r"(?i)(call|tel|phone|fon|mobil|fax)[^0-9]*$", 2: r"(?i)(mail|contact|write)[^0-9]*$", 3: r"(?i)(card|visa|credit|karte|carte)[^0-9]*$", 4: r"(?i)(\bip\b|host|server|addr)[^0-9]*$"}
#: The context that goes with a source: mails, numbers.
OWN_CONTEXT = {0: 2, 1: 1}
#: Values each description number can take: their product bounds the table of counts.
SIZES = {"source": 2, "digits": 8, "dots": 5, "blanks": 3, "context": 5, "length": 4}
ROUNDS, RATE, PRECISION = 30, 0.3, 0.98

_SPANS = "array<struct<start:int,end:int,match:string,before:string>>"


def _found(text: Column, pattern: str) -> Column:
    """Matches of a pattern as spans in code points, with the text before each.

    The text must be free of the two marks, which are put around each match.
    """
    parts = F.split(F.regexp_replace(text, pattern, "\x01$0\x02"), "\x01", -1)
    head = F.element_at(parts, 1)
    start = F.struct(F.length(head).alias("pos"), F.right(head, F.lit(30)).alias("before"), F.array().cast(_SPANS).alias("spans"))

    def step(state: Column, part: Column) -> Column:
        match = F.substring_index(part, "\x02", 1)
        end = state["pos"] + F.length(match)
        span = F.struct(state["pos"].alias("start"), end.alias("end"), match.alias("match"), state["before"].alias("before"))
        return F.struct(
            (state["pos"] + F.length(part) - 1).alias("pos"),
            F.right(F.substring_index(part, "\x02", -1), F.lit(30)).alias("before"),
            F.concat(state["spans"], F.array(span)).alias("spans"),
        )

    return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), start, step, lambda state: state["spans"])


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = F.reverse(_digits(match))

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _failed_spans(kind: str) -> Column:
    """Matches of the strict pattern that do not pass its check."""
    failing = F.filter(f"_{kind}", lambda span: ~_passes(kind, span["match"]))
    return F.transform(failing, lambda span: F.struct(span["start"].alias("start"), span["end"].alias("end")))


def _base_spans(at: int, kind: str) -> Column:
    passing = F.filter(f"_{kind}", lambda span: _passes(kind, span["match"]))
    return F.transform(
        passing, lambda span: F.struct(span["start"].alias("start"), F.lit(at).alias("at"), span["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def of_kind(spans: str, kind: str) -> Column:
    """How many spans of this kind there are."""
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


def _bucket(value: Column, *bounds: int) -> Column:
    """How many of the ascending bounds the value reaches."""
    return sum((F.when(value >= bound, 1).otherwise(0) for bound in bounds), F.lit(0))


def _described(span: Column, source: int) -> Column:
    match, before = span["match"], span["before"]
    if source == 0:  # spelled-out mails as if written with signs
        match = F.regexp_replace(match, r" ?(?:@|\(at\)|\[at\]) ?| at ", "@")
        match = F.regexp_replace(match, r" ?\(dot\) ?| ?\[dot\] ?| dot ", ".")
    else:
        match = F.regexp_replace(match, r"^\+", "")
    context = F.lit(0)
    for number, pattern in reversed(CONTEXT.items()):
        context = F.when(before.rlike(pattern), number).otherwise(context)
    return F.struct(
        span["start"].alias("start"),
        span["end"].alias("end"),
        F.lit(source).alias("source"),
        _bucket(F.length(_digits(match)), 1, 7, 10, 14, 16, 17, 20).alias("digits"),
        F.least(F.length(match) - F.length(F.translate(match, ".", "")), F.lit(4)).alias("dots"),
        F.when(match.rlike("[-()/]"), 2).when(F.contains(match, F.lit(" ")), 1).otherwise(0).alias("blanks"),
        context.alias("context"),
        _bucket(F.length(match), 10, 16, 24).alias("length"),
    )


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `_base` (kind, start, end per span, by start, then kind) and `_candidates`. A null text has none of either."""
    clean = F.translate(F.coalesce(F.col(text), F.lit("")), "\x01\x02", "\x03\x03")
    may = {"email": F.contains("_clean", F.lit("@")), "ip": F.col("_clean").rlike(r"[0-9]\.[0-9]"), "card": F.col("_clean").rlike(r"[0-9](?:[ -]?[0-9]){13}"), "phone": F.contains("_clean", F.lit("+"))}
    none = F.array().cast(_SPANS)
    out = docs.withColumn("_clean", clean)
    for kind in KINDS:
        out = out.withColumn(f"_{kind}", F.when(may[kind], _found(F.col("_clean"), PATTERNS[kind])).otherwise(none))
    base = [_base_spans(at, kind) for at, kind in enumerate(KINDS)]
    out = out.withColumn("_base", F.array_sort(F.concat(*base)))
    mails = F.when(F.col("_clean").rlike(r"@|[\[(]at[\])]| dot "), _found(F.col("_clean"), LOOSE["email"])).otherwise(none)
    numbers = F.when(F.col("_clean").rlike(r"[0-9](?:[ ().+/-]{0,3}[0-9]){6}"), _found(F.col("_clean"), LOOSE["phone"])).otherwise(none)
    out = out.withColumn("_mails", mails).withColumn("_numbers", numbers)
    candidates = F.concat(
        F.transform("_mails", lambda span: _described(span, 0)), F.transform("_numbers", lambda span: _described(span, 1))
    )
    out = out.withColumn("_failed", F.concat(*[_failed_spans(kind) for kind in KINDS if kind != "email"]))
    marked = F.transform(candidates, lambda c: c.withField("fails", _touched(c, F.col("_failed"))))
    return out.withColumn("_candidates", marked).drop("_failed", "_clean", "_mails", "_numbers", *[f"_{kind}" for kind in KINDS])


def _touched(candidate: Column, base: Column) -> Column:
    return F.exists(base, lambda span: (span["start"] < candidate["end"]) & (candidate["start"] < span["end"]))


class BoostedTrees:
    """Trees of two levels over the description numbers, and a calibrated threshold."""

    def __init__(self, base: float, trees: list[tuple], threshold: float):
        self.base, self.trees, self.threshold = base, trees, threshold

    def margin(self, row) -> float:
        """Of a mapping or a struct column's fields, for plain numbers."""
        total = self.base
        for name, bound, sides in self.trees:
            other, cut, low, high = sides[row[name] > bound]
            total += low if row[other] <= cut else high
        return total

    def column(self, candidate: Column) -> Column:
        total = F.lit(self.base)
        for name, bound, (left, right) in self.trees:
            side = [F.when(candidate[other] <= cut, low).otherwise(high) for other, cut, low, high in (left, right)]
            total = total + F.when(candidate[name] <= bound, side[0]).otherwise(side[1])
        return total


def fit(cells: list[dict], rounds: int = ROUNDS, rate: float = RATE, precision: float = PRECISION) -> BoostedTrees:
    """From rows of description numbers with n, covered and aside (1: for calibration). Without candidates nothing is added."""
    train = [cell for cell in cells if not cell["aside"]]
    aside = [cell for cell in cells if cell["aside"]]
    n, covered = sum(c["n"] for c in train), sum(c["covered"] for c in train)
    if not n or not aside:
        return BoostedTrees(-30.0, [], math.inf)
    model = BoostedTrees(math.log((covered + 1) / (n - covered + 1)), [], math.inf)
    margins = [model.base] * len(train)

    def split(rows: list[int], grad, hess):
        """The best cut of these rows: (gain, name, bound, low value, high value)."""
        g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        best = (0.0, "source", -1, 0.0, g / (h + 1))
        for name, size in SIZES.items():
            by = [[0.0, 0.0] for _ in range(size)]
            for i in rows:
                cell = by[train[i][name]]
                cell[0] += grad[i]
                cell[1] += hess[i]
            a = b = 0.0
            for bound in range(size - 1):
                a, b = a + by[bound][0], b + by[bound][1]
                gain = a * a / (b + 1) + (g - a) ** 2 / (h - b + 1) - g * g / (h + 1)
                if gain > best[0] + 1e-12:
                    best = (gain, name, bound, a / (b + 1), (g - a) / (h - b + 1))
        return best

    for _ in range(rounds):
        p = [1 / (1 + math.exp(-max(-30, min(30, m)))) for m in margins]
        grad = [c["covered"] - c["n"] * q for c, q in zip(train, p)]
        hess = [c["n"] * q * (1 - q) for c, q in zip(train, p)]
        rows = list(range(len(train)))
        _, name, bound, _, _ = split(rows, grad, hess)
        sides = []
        for side in ([i for i in rows if train[i][name] <= bound], [i for i in rows if train[i][name] > bound]):
            _, other, cut, low, high = split(side, grad, hess)
            sides.append((other, cut, rate * low, rate * high))
            for i in side:
                margins[i] += rate * (low if train[i][other] <= cut else high)
        model.trees.append((name, bound, tuple(sides)))
    total = right = 0
    for margin, n, covered in sorted(((model.margin(c), c["n"], c["covered"]) for c in aside), reverse=True):
        total, right = total + n, right + covered
        if right < precision * total:
            break
        model.threshold = margin
    return model


def train(found: DataFrame) -> BoostedTrees:
    """Fit on all examples of a table from `with_candidates` that still has doc_id."""
    flat = found.select("doc_id", "_base", F.explode("_candidates").alias("c")).select(
        *[F.col("c")[name].alias(name) for name in SIZES],
        F.col("c")["fails"].alias("fails"),
        _touched(F.col("c"), F.col("_base")).cast("long").alias("y"),
        F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0, F.lit(False)).cast("int").alias("aside"),
    )
    own = F.lit(False)
    for source, context in OWN_CONTEXT.items():
        own = own | ((F.col("source") == source) & (F.col("context") == context))
    flat = flat.where((F.col("y") == 1) | F.col("fails") | ~own)
    cells = flat.groupBy(*SIZES, "aside").agg(F.count("*").alias("n"), F.sum("y").alias("covered")).collect()
    return fit([cell.asDict() for cell in sorted(cells)])


def with_spans(found: DataFrame, model: BoostedTrees) -> DataFrame:
    """`_spans`: the base spans and the candidates that score at least the threshold and touch none of them."""
    if math.isinf(model.threshold):
        return found.withColumn("_spans", F.col("_base"))
    chosen = F.filter(
        "_candidates", lambda c: (model.column(c) >= F.lit(model.threshold)) & ~_touched(c, F.col("_base"))
    )
    kind = lambda c: F.when(c["source"] == 0, "email").otherwise("phone")
    at = lambda c: F.when(c["source"] == 0, 0).otherwise(3)
    added = F.transform(chosen, lambda c: F.struct(c["start"].alias("start"), at(c).alias("at"), c["end"].alias("end"), kind(c).alias("kind")))
    return found.withColumn("_spans", F.array_sort(F.concat("_base", added)))


def spelled(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, _base, _candidates, _spans): spans and candidates are stored once, then read to fit and to select.

    Every row gives a row, null texts and ids included; other columns are not read.
    """
    found = Stored(with_candidates(docs.select("doc_id", "text")).drop("text"), "pii").df
    return with_spans(found, train(found))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of `text` replaced by its kind in brackets; overlapping spans become one.

    All other columns stay as they are, whatever their names; a null text stays null.
    """
    plain = docs.select("doc_id", "text")
    found = Stored(with_candidates(plain).drop("text"), "pii")
    model = train(found.df)
    found.remove()
    inner, own = hidden(docs, "doc_id", "text")
    marked = with_spans(with_candidates(inner), model)
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        begins = span["start"] >= state["pos"]
        more = F.concat(state["out"], F.substr(F.col("text"), state["pos"] + 1, span["start"] - state["pos"]), F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.struct(F.greatest(state["pos"], span["end"]).alias("pos"), F.when(begins, more).otherwise(state["out"]).alias("out"))

    done = F.aggregate("_spans", start, step, lambda s: F.concat(s["out"], F.substr(F.col("text"), s["pos"] + 1, F.length("text"))))
    text = F.when(F.size("_spans") > 0, done).otherwise(F.col("text")).alias("text")
    return marked.select(*[text if name == "text" else column for name, column in own.items()])
