"""Personal data: rule spans, and candidate spans chosen by gradient boosted trees.

Everything on the main path is DataFrame functions within a row.  Rules find base
spans.  High-recall generators propose further, overlapping candidates: what holds an at
sign, addresses that are spelled out, number runs and their parts.  Each has a small
vector of format and context features from a finite space, and a weak label: whether a
base span touches it, or whether its plain form (marks for at and dot, and separators,
rewritten) satisfies a rule.  The counts of each feature vector and label come to the
driver (at most twice as many rows as there are vectors), where boosted trees are fitted
to those of four fifths of the texts.  A threshold is calibrated on the counts of the
other fifth; equal texts are on the same side.  Candidates whose score reaches it and that
touch no base span are added; of those of a kind that overlap, the first.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isallobar.llm.common import as_row, named, settle

KINDS = ("email", "ip", "card", "phone")

#: Trees, their depth, the learning rate, and the precision that the threshold must reach on weak labels, which count what the rules miss as wrong.
TREES, DEPTH, RATE, PRECISION = 24, 3, 0.3, 0.8
#: Least number of held-out candidates (by count) that a threshold may rest on.
SUPPORT = 20

# Each rule starts only where a run starts or where the last match ended (\\G), which
# finds the same spans and keeps long runs linear; loops are possessive for the same reason.
RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for its rule to be tried at all.
HINTS = {"email": ("has", "@"), "ip": ("like", r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), "card": ("like", r"[0-9](?:[\x20-]?[0-9]){15}"), "phone": ("has", "+")}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# Ways to write at and dot.
AT_MARK, DOT_MARK = r"\x20?[(\[{](?i:at)[)\]}]\x20?|\x20(?i:at)\x20", r"\x20?[(\[{](?i:dot)[)\]}]\x20?|\x20(?i:dot)\x20"
GENERATORS = {
    "at": r"(?:\G|(?<![^\s@]))[^\s@]++@[^\s@]++",
    "number": r"(?:\G|(?<![0-9]))[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+",
    "spelled": rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:{AT_MARK})[A-Za-z0-9-]++(?:(?:{DOT_MARK}|\.)[A-Za-z0-9-]++)++",
}
FORMS = {"at": 0, "number": 1, "spelled": 2}
GENERATOR_HINTS = {"spelled": ("like", rf"[A-Za-z0-9](?:{AT_MARK})[A-Za-z0-9]"), "at": ("has", "@"), "number": ("like", r"[0-9](?:[\x20().-]{0,2}[0-9]){6}")}
CUES = r"(?i)(?:mail|contact|write|phone|tel|call|mobile|card|visa|pay|account|host|server|addr|\bip\b)"
#: Characters of context before and after a candidate.
CONTEXT = 24

SPAN = "array<struct<start:int,end:int>>"
PLACED = "array<struct<start:int,end:int,text:string,before:string,after:string>>"
#: Digits of a part of a number run, and the most digits of a run that may be one phone number, so has no parts.
PART_DIGITS, PHONE_DIGITS = (7, 19), 15


def _hint(text: Column, hint: tuple[str, str]) -> Column:
    return F.contains(text, F.lit(hint[1])) if hint[0] == "has" else F.rlike(text, F.lit(hint[1]))


def _cut(text: Column, pattern: str, hint: tuple[str, str]) -> Column:
    """Matches of a pattern and the pieces between them; null where there are none."""
    return F.when(_hint(text, hint), F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("pieces")))


def _placed(cut: Column) -> Column:
    """Matches as (start, end, text, before, after), in code points."""
    found, pieces = cut["found"], cut["pieces"]
    starts = F.aggregate(
        F.sequence(F.lit(0), F.size(found) - 1),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, i: F.struct(
            (acc["at"] + F.length(F.get(pieces, i)) + F.length(F.get(found, i))).alias("at"),
            F.concat(acc["out"], F.array(acc["at"] + F.length(F.get(pieces, i)))).alias("out"),
        ),
        lambda acc: acc["out"],
    )

    def one(start: Column, i: Column) -> Column:
        text = F.get(found, i)
        return F.struct(start.alias("start"), (start + F.length(text)).alias("end"), text.alias("text"), F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(CONTEXT)).alias("after"))

    return F.when(F.size(found) > 0, F.transform(starts, one)).otherwise(F.array().cast(PLACED))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a short string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        x = F.substring(digits, i, 1).cast("int")
        return total + F.when((F.length(digits) - i) % 2 == 1, 2 * x - F.when(x > 4, 9).otherwise(0)).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.rlike(x["text"], F.lit(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
    digits = _digits(x["text"])
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 15)


# Feature vectors: name and number of values.
FEATURES = (("form", 3), ("digits", 7), ("bracket", 2), ("gaps", 2), ("dots", 3), ("luhn", 2), ("quad", 2), ("glued", 2), ("cue", 2), ("domain", 3))


def _plain(generator: str, x: Column) -> Column:
    """Whether the plain form of a candidate satisfies a rule that the candidate as written may miss."""
    text = x["text"]
    if generator == "spelled":
        marked = F.rlike(text, F.lit(rf"[(\[{{](?i:at)[)\]}}]|{DOT_MARK}"))
        return marked & F.rlike(F.regexp_replace(F.regexp_replace(text, AT_MARK, "@"), DOT_MARK, "."), F.lit(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"))
    if generator == "number":
        digits = _digits(text)
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    return F.lit(False)


def _pattern(generator: str, x: Column) -> Column:
    """Feature vector of a candidate as one number."""
    number = generator == "number"
    text, digits = x["text"], _digits(x["text"])
    n = F.length(digits)
    size = F.when(n < 7, 0).when(n < 9, 1).when(n < 12, 2).when(n < 16, 3).when(n < 20, 4).when(n < 40, 5).otherwise(6)
    dots = F.length(text) - F.length(F.replace(text, F.lit("."), F.lit("")))
    if generator == "spelled":  # how at and dot are written
        kept = F.rlike(text, F.lit(r"[(\[{](?i:at)[)\]}]")).cast("int"), F.rlike(text, F.lit(DOT_MARK)).cast("int")
    else:
        kept = F.rlike(text, F.lit(r"[()]")).cast("int"), F.rlike(text, F.lit(r"[\x20-]")).cast("int")
    flags = [
        F.lit(FORMS[generator]),
        size if number else F.lit(0),
        *kept,
        F.when(dots == 0, 0).when(dots == 3, 2).otherwise(1),
        F.when(n.between(12, 19), luhn(digits)).otherwise(False).cast("int") if number else F.lit(0),
        F.rlike(text, F.lit(rf"^{BYTE}(?:\.{BYTE}){{3}}$")).cast("int") if number else F.lit(0),
        (F.rlike(x["before"], F.lit(r"[\p{L}\p{N}_]$")) | F.rlike(x["after"], F.lit(r"^[\p{L}\p{N}_]"))).cast("int"),
        F.rlike(x["before"], F.lit(CUES)).cast("int"),
        F.lit(0) if number else F.when(F.rlike(text, F.lit(rf"(?:@.*\.|{AT_MARK}).*?[A-Za-z]{{2,}}[.,;:!?)]*$")), 2).when(F.rlike(text, F.lit(r"@[^@]*\.")), 1).otherwise(0),
    ]
    key: Column = F.lit(0)
    for (_, values), flag in zip(FEATURES, flags, strict=True):
        key = key * values + flag
    return key.cast("int")


def features_of(pattern: int) -> list[int]:
    """The feature values that a pattern number stands for."""
    out = []
    for _, values in reversed(FEATURES):
        pattern, value = divmod(pattern, values)
        out.append(value)
    return out[::-1]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parts(x: Column) -> Column:
    """Proper parts of a placed number run that start and end at separators and have 7 to 19 digits."""

    def of(groups: Column) -> Column:
        def one(first: Column, i: Column) -> Column:
            sign = F.regexp_extract(first["before"], "[+(]$", 0)
            before = F.concat(F.right(x["before"], F.greatest(F.lit(0), F.lit(CONTEXT) - first["start"])), first["before"])

            def step(acc: Column, t: Column) -> Column:
                n = F.least(acc["n"] + F.length(t["text"]), F.lit(PART_DIGITS[1] + 1))
                fits = n <= PART_DIGITS[1]
                text = F.when(fits, F.concat(acc["text"], F.when(acc["n"] > 0, t["before"]).otherwise(""), t["text"])).otherwise("")
                signed = (n < 13) & (sign != "")
                start = first["start"] - F.when(signed, 1).otherwise(0)
                after = F.when(t["after"] == "", x["after"]).otherwise(t["after"])
                part = F.struct(
                    (x["start"] + start).alias("start"),
                    (x["start"] + t["end"]).alias("end"),
                    F.when(signed, F.concat(sign, text)).otherwise(text).alias("text"),
                    F.when(signed, F.left(before, F.length(before) - 1)).otherwise(before).alias("before"),
                    after.alias("after"),
                )
                proper = (start > 0) | (t["end"] < F.length(x["text"]))
                out = F.when(n.between(*PART_DIGITS) & proper, F.concat(acc["out"], F.array(part))).otherwise(acc["out"])
                return F.struct(n.alias("n"), text.alias("text"), out.alias("out"))

            empty = F.struct(F.lit(0).alias("n"), F.lit("").alias("text"), F.array().cast(PLACED).alias("out"))
            return F.aggregate(F.slice(groups, i + 1, PART_DIGITS[1]), empty, step, lambda acc: acc["out"])

        return F.flatten(F.transform(groups, one))

    cut = F.struct(F.regexp_extract_all(x["text"], F.lit("[0-9]+"), F.lit(0)).alias("found"), F.split(x["text"], "[0-9]+", -1).alias("pieces"))
    many = F.rlike(x["text"], F.lit(r"[0-9][^0-9]+[0-9]")) & (F.length(_digits(x["text"])) > PHONE_DIGITS)
    return F.when(many, _let(_let(cut, _placed), of)).otherwise(F.array().cast(PLACED))


def _touches(x: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``pii_base`` (spans by kind) and ``pii_candidates`` to every row.

    A candidate is (kind, start, end, pattern, hit, good), where ``hit`` says that a base span
    touches it, and ``good`` is its weak label.  Number runs of more digits than a phone number has are candidates whole,
    and so are their parts between separators that touch no base span.  Null texts are empty.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    cuts = [_cut(whole, RULES[k], HINTS[k]).alias(f"pii_{k}") for k in KINDS] + [_cut(whole, GENERATORS[k], GENERATOR_HINTS[k]).alias(f"pii_{k}") for k in GENERATORS]
    first = docs.select("*", *cuts)

    def base(kind: str) -> Column:
        sound = F.filter(_placed(F.col(f"pii_{kind}")), lambda x: _valid(kind, x))
        spans = F.transform(sound, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
        return F.coalesce(spans, F.array().cast(SPAN)).alias(kind)

    def proposed(generator: str) -> Column:
        number = generator == "number"
        shape = "array<struct<kind:string,start:int,end:int,pattern:int,plain:boolean,part:boolean>>"

        def one(x: Column, part: bool = False) -> Column:
            n = F.length(_digits(x["text"]))
            kind = F.when(F.rlike(x["text"], F.lit(r"^[0-9]+(?:\.[0-9]+){3}$")), "ip").when(n >= 13, "card").otherwise("phone") if number else F.lit("email")
            return F.struct(kind.alias("kind"), x["start"].alias("start"), x["end"].alias("end"), _pattern(generator, x).alias("pattern"), _plain(generator, x).alias("plain"), F.lit(part).alias("part"))

        def every(runs: Column) -> Column:
            whole = F.transform(runs, lambda x: one(x))
            return F.concat(whole, F.transform(F.flatten(F.transform(runs, lambda x: _parts(x))), lambda x: one(x, part=True))) if number else whole

        return F.coalesce(_let(_placed(F.col(f"pii_{generator}")), every), F.array().cast(shape))

    second = first.select(*(named(docs, c) for c in docs.columns), F.struct(*(base(k) for k in KINDS)).alias("pii_base"), F.concat(*(proposed(g) for g in GENERATORS)).alias("pii_found"))
    every = F.concat(*(F.col("pii_base")[k] for k in KINDS))
    free = F.filter("pii_found", lambda x: ~x["part"] | ~_touches(x, every))

    def labelled(x: Column) -> Column:
        return _let(_touches(x, every), lambda hit: F.struct(*(x[k].alias(k) for k in ("kind", "start", "end", "pattern")), hit.alias("hit"), (hit | x["plain"]).alias("good")))

    apart = F.pmod(F.xxhash64(whole), F.lit(5)) == 0
    return second.select(*(named(second, c) for c in docs.columns), "pii_base", F.transform(free, labelled).alias("pii_candidates"), apart.alias("pii_apart"))


@dataclass
class Tree:
    """A regression tree over feature values: split on feature <= value, or a leaf."""

    feature: int = -1
    value: int = 0
    sides: list["Tree"] = field(default_factory=list)
    leaf: float = 0.0

    def predict(self, x: list[int]) -> float:
        node = self
        while node.sides:
            node = node.sides[x[node.feature] > node.value]
        return node.leaf


def _grow(rows: list[tuple[list[int], float, float]], depth: int) -> Tree:
    """Fit gradients: rows are (features, gradient, curvature) sums."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best, chosen = 1e-6, None
    if depth and len(rows) > 1:
        for f, (_, values) in enumerate(FEATURES):
            sums = [[0.0, 0.0] for _ in range(values)]
            for x, dg, dh in rows:
                sums[x[f]][0] += dg
                sums[x[f]][1] += dh
            lg = lh = 0.0
            for v in range(values - 1):
                lg, lh = lg + sums[v][0], lh + sums[v][1]
                if min(lh, h - lh) < 1e-3:
                    continue
                gain = lg * lg / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g * g / (h + 1)
                if gain > best:
                    best, chosen = gain, (f, v)
    if chosen is None:
        return Tree(leaf=RATE * g / (h + 1))
    f, v = chosen
    parts = [[r for r in rows if (r[0][f] > v) == side] for side in (False, True)]
    return Tree(f, v, [_grow(p, depth - 1) for p in parts])


@dataclass(frozen=True)
class Chooser:
    """Boosted trees, the calibrated threshold, and the patterns that reach it."""

    bias: float
    trees: tuple[Tree, ...]
    threshold: float
    accepted: tuple[int, ...]

    def score(self, x: list[int]) -> float:
        return 1 / (1 + math.exp(-self.bias - sum(t.predict(x) for t in self.trees)))


def fit_chooser(counts: list[tuple[int, bool, bool, int]]) -> Chooser:
    """Fit on (pattern, weak label, held out, count) rows; nothing to learn from accepts nothing."""
    learn: dict[int, list[float]] = {}
    for pattern, hit, out, n in counts:
        if not out:
            learn.setdefault(pattern, [0.0, 0.0])[hit] += n
    good, total = sum(v[1] for v in learn.values()), sum(sum(v) for v in learn.values())
    if not total or good in (0, total):
        return Chooser(0.0, (), 1.1, ())
    scale = 1e4 / total  # counts become shares, so the fit is alike at every size
    bias = math.log(good / (total - good))
    data = [(features_of(p), v[1] * scale, (v[0] + v[1]) * scale) for p, v in sorted(learn.items())]
    margin = [bias] * len(data)
    trees: list[Tree] = []
    for _ in range(TREES):
        rows = []
        for (x, y, w), m in zip(data, margin, strict=True):
            p = 1 / (1 + math.exp(-m))
            rows.append((x, y - w * p, w * p * (1 - p)))
        trees.append(_grow(rows, DEPTH))
        margin = [m + trees[-1].predict(x) for (x, _, _), m in zip(data, margin, strict=True)]
    model = Chooser(bias, tuple(trees), 1.1, ())
    # The least threshold from which on held-out candidates have a good label often enough.
    scored = sorted(((model.score(features_of(p)), hit, n) for p, hit, out, n in counts if out), reverse=True)
    threshold, hits, seen = 1.1, 0, 0
    for k, (s, hit, n) in enumerate(scored):
        hits, seen = hits + n * hit, seen + n
        if (k + 1 == len(scored) or scored[k + 1][0] < s) and seen >= SUPPORT and hits >= PRECISION * seen:
            threshold = s
    accepted = tuple(sorted({p for p, _, _, _ in counts if model.score(features_of(p)) >= threshold}))
    return Chooser(bias, tuple(trees), threshold, accepted)


def learned(marked: DataFrame) -> Chooser:
    """Fit the chooser to the candidates of all rows; one count for each feature vector is collected."""
    one = marked.select(F.explode("pii_candidates").alias("c"), F.col("pii_apart").alias("out"))
    counts = one.groupBy(F.col("c.pattern").alias("p"), F.col("c.good").alias("good"), "out").agg(F.count("*").alias("n")).collect()
    return fit_chooser([(r.p, r.good, r.out, r.n) for r in counts])


def _apart(found: Column) -> Column:
    """Of candidates of one kind that overlap, the first, and of those that start together the longest."""
    ordered = F.array_sort(F.transform(found, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"))))
    step = lambda acc, x: F.when(x["start"] >= acc["at"], F.struct((-x["back"]).alias("at"), F.concat(acc["out"], F.array(F.struct(x["start"].alias("start"), (-x["back"]).alias("end")))).alias("out"))).otherwise(acc)
    return F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")), step, lambda acc: acc["out"])


def all_spans(chooser: Chooser) -> dict[str, Column]:
    """Base and added spans of each kind, by start, for rows of :func:`with_spans`."""
    shape = "array<struct<kind:string,start:int,end:int,pattern:int,hit:boolean,good:boolean>>"
    added = F.filter("pii_candidates", lambda x: ~x["hit"] & x["pattern"].isin(*chooser.accepted)) if chooser.accepted else F.array().cast(shape)

    def of(kind: str) -> Column:
        own = _apart(F.filter(added, lambda x: x["kind"] == F.lit(kind)))
        return F.array_sort(F.concat(F.col("pii_base")[kind], F.transform(own, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))))

    return {k: of(k) for k in KINDS}


def _joined(spans: dict[str, Column]) -> Column:
    def of(kind: str) -> Column:
        return F.transform(spans[kind], lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string")))

    return F.array_join(F.concat(*(of(k) for k in KINDS)), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data in every whole text.

    Returns doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 and spans (base
    and added ones).  Null and empty texts have no spans: counts of zero, the digest
    of the empty string and an empty list.  Repeated rows each give a row, null ids
    stay null, other columns are ignored, an empty table gives no rows.
    """
    marked = settle(with_spans(docs.select("doc_id", "text")).drop("text"), "spans")
    spans = all_spans(learned(marked))
    base = {k: F.col("pii_base")[k] for k in KINDS}
    return marked.select("doc_id", *(F.size(base[k]).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``; in ``text``, spans give way to [EMAIL], [IP], [CARD] or [PHONE].

    Overlapping spans are replaced once, under the name of the first.  Null texts stay
    null; texts without spans stay as they are.
    """
    chooser = learned(with_spans(docs.select("text")).drop("text"))
    marked = with_spans(docs.select(as_row(docs), "text"))
    spans = all_spans(chooser)

    def of(kind: str) -> Column:
        return F.transform(spans[kind], lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind")))

    every = F.array_sort(F.concat(*(of(k) for k in KINDS)))

    def step(acc: Column, x: Column) -> Column:
        after = F.when(
            x["start"] >= acc["at"],
            F.concat(acc["out"], F.array(F.substring(F.col("text"), acc["at"] + 1, x["start"] - acc["at"]), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))),
        ).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), after.alias("out"))

    ready = marked.select("*", every.alias("pii_all"))
    parts = F.aggregate("pii_all", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    text = F.when(F.col("text").isNotNull() & (F.size("pii_all") > 0), parts).otherwise(F.col("text"))
    return ready.select(*(text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))
