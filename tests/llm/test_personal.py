"""Personal data against plain regular expressions, and redaction against string building."""

import hashlib
import re

from isallobar.llm import pii
from tests.llm.fixtures import PII, TEXTS, documents, empty

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(int(x) if k % 2 == 0 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(reversed(d))) % 10 == 0


def base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", m) for m in EMAIL.finditer(text)]
    out += [("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


HARD = [*TEXTS, "a" * 20000 + " b", "1" * 30000, ".".join(["1"] * 3000), "x@" + ".".join(["a"] * 5000), "+" + "1 " * 20, "0004.00.255.0000001", "a@b.c" * 4, "é@x.y +1234567(8", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "+1-+1-5555-1234", "a@b..c a@-.-", "ü1.1.1.1ü"]


def test_base_spans_equal_plain_expressions(spark):
    docs = documents(spark, HARD)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = pii.find_personal_data(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        spans = base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS], r.doc_id
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (r.doc_id, spans)
        assert set(joined.split(",")) <= set(r.spans.split(",")) | {""}
    assert pii.find_personal_data(empty(spark)).count() == 0


def test_learned_spans_are_added_and_base_ones_stay(spark):
    # Valid and invalid quads look alike but for the number; valid ones are nearly all of their kind.
    texts = [f"host {k % 250}.{k % 200}.3.{k % 99} ok card 41111111111111{k % 90 + 10}" for k in range(600)]
    docs = documents(spark, texts)
    marked = pii.with_spans(docs.select("doc_id", "text")).drop("text")
    chooser = pii.learned(marked)
    assert chooser.trees and 0 < chooser.threshold <= 1 and chooser.accepted
    for p in chooser.accepted:
        assert chooser.score(pii.features_of(p)) >= chooser.threshold
    # All accepted candidates that touch no base span, and nothing else, are added.
    spans = pii.all_spans(chooser)
    for r in marked.select("doc_id", "pii_base", "pii_candidates", *(spans[k].alias(k) for k in pii.KINDS)).collect():
        for k in pii.KINDS:
            held = {(s.start, s.end) for s in r.pii_base[k]}
            extra = {(c.start, c.end) for c in r.pii_candidates if c.kind == k and not c.hit and c.pattern in chooser.accepted}
            assert {(s.start, s.end) for s in r[k]} == held | extra and held <= {(s.start, s.end) for s in r[k]}


def test_an_accepted_pattern_adds_its_spans(spark):
    docs = documents(spark, ["call 555 123 4567 now", "+1 555 123 4567"])
    marked = pii.with_spans(docs.select("doc_id", "text")).drop("text")
    patterns = {c.pattern for r in marked.collect() for c in r.pii_candidates if not c.hit}
    chooser = pii.Chooser(0.0, (), 0.5, tuple(patterns))
    got = {r.doc_id: r.s for r in marked.select("doc_id", pii._joined(pii.all_spans(chooser)).alias("s")).collect()}
    assert got[0] == "phone:5:17" and got[1] == "phone:0:15"


def test_trees_learn_what_tells_spans_apart():
    counts = []
    for k in range(40):
        pattern = k * 37 % 5000
        good = pii.features_of(pattern)[1] >= 4
        counts += [(pattern, good, out, 50) for out in (False, True)]
    chooser = pii.fit_chooser(counts)
    for pattern, good, _, _ in counts:
        assert (chooser.score(pii.features_of(pattern)) >= chooser.threshold) == good
    assert pii.fit_chooser([]).accepted == ()
    assert pii.fit_chooser([(1, True, False, 5)]).accepted == ()


def test_redaction(spark):
    docs = documents(spark, ["no data", PII, None, "a@b.c", "x a@b.c +1 555 123 4567 y", "10.0.0.1@x.y é"])
    rows = {(r.doc_id, r.length): r for r in pii.redact(docs).collect()}
    assert pii.redact(docs).columns == docs.columns
    assert rows[0, 1.0].text == "no data" and rows[2, 1.0].text is None and rows[3, 1.0].text == "[EMAIL]"
    assert rows[4, 1.0].text == "x [EMAIL] [PHONE] y" and rows[5, 1.0].text == "[IP] é"
    assert not base(rows[1, 1.0].text) and "[CARD]" in rows[1, 1.0].text and rows[1, 1.0].text.startswith("write to [EMAIL], or ")
    assert len(rows) == docs.count()


def test_parts_of_a_failed_run_are_proposed_and_added(spark):
    # The base rule takes both cards as one number of 32 digits and drops it.
    two = "pay 7536784127813050 4845168114407329 now"
    docs = documents(spark, [two, *("-" * (k % 60) + f" card 4111111111111111 call 555 123 {k}" for k in range(1000, 1600))])
    marked = pii.with_spans(docs.select("doc_id", "text")).drop("text")
    found = {(c.kind, c.start, c.end) for r in marked.where("doc_id = 0").collect() for c in r.pii_candidates}
    assert found == {("card", 4, 37), ("card", 4, 20), ("card", 21, 37)}
    rows = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert rows[0].spans == "card:4:20,card:21:37" and rows[0].n_card == 0
    assert {r.text for r in pii.redact(docs).where("doc_id = 0").collect()} == {"pay [CARD] [CARD] now"}


def test_parts_are_all_runs_of_groups(spark):
    for text in ("+12 345 (678) 9012-3456.7890 123 4567890123 45 é", "x1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2", "5" * 25 + " 1234567 12"):
        run = re.search(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9])+", text)
        groups = [(m.start() + run.start(), m.end() + run.start()) for m in re.finditer("[0-9]+", run[0])]
        wanted = {run.span()}
        for i, (start, _) in enumerate(groups):
            for _, end in groups[i:]:
                n = len(re.sub("[^0-9]", "", text[start:end]))
                if 7 <= n <= 19:
                    wanted.add((start - (n < 13 and text[start - 1 : start] in ("+", "(")), end))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        row = pii.with_spans(docs).first()
        base = [(x.start, x.end) for k in pii.KINDS for x in row.pii_base[k]]
        wanted = {w for w in wanted if w == run.span() or not any(a < w[1] and w[0] < b for a, b in base)}
        assert {(c.start, c.end) for c in row.pii_candidates} == wanted, text


def test_other_ways_to_write_are_found_without_touching_clean_texts(spark):
    import random

    rnd = random.Random(4)
    name = lambda: "".join(rnd.choices("abcdefgh", k=6))
    number = lambda k: "".join(rnd.choices("0123456789", k=k))

    def card():
        head = "4" + number(14)
        return next(head + d for d in "0123456789" if luhn(head + d))

    grouped = lambda c, s: s.join(c[k : k + 4] for k in range(0, 16, 4))
    plain = [f"{name()} writes to {name()}@{name()}.org and calls +1 ({number(3)}) 555-{number(4)} or pays {card()} {name()}" for _ in range(300)]
    plain += [f"{name()} at {name()} looked at {name()} in {number(4)}, {number(6)} of {number(14)} {name()}" for _ in range(300)]
    spelled = [(f"{name()} is {(w := name() + rnd.choice([' at ', ' (at) ', '[at]']) + name() + rnd.choice([' dot ', ' (dot) ', '[dot]']) + 'com')} or so", "email", w) for _ in range(60)]
    dotted = [(f"pay {(w := grouped(card(), rnd.choice(['.', '  '])))} now", "card", w) for _ in range(60)]
    phones = [(f"call {(w := f'({number(3)}) 555-{number(4)}')} now", "phone", w) for _ in range(60)]
    hidden = [*spelled, *dotted, *phones]
    docs = documents(spark, [*plain, *(t for t, _, _ in hidden)]).where("doc_id IS NOT NULL AND length = 1.0")
    rows = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    added = found = 0
    for k, (text, kind, what) in enumerate(hidden, len(plain)):
        spans = {s for s in rows[k].spans.split(",") if s}
        base_spans = {f"{a}:{b}:{c}" for a, b, c in base(text)}
        added += len(spans - base_spans)
        found += f"{kind}:{text.index(what)}:{text.index(what) + len(what)}" in spans
    wrong = sum(len({s for s in rows[k].spans.split(",") if s} - {f"{a}:{b}:{c}" for a, b, c in base(t)}) for k, t in enumerate(plain))
    assert found >= 0.8 * len(hidden) and wrong == 0, (found, added, wrong)


def test_columns_with_dots_stay(spark):
    docs = spark.createDataFrame([(1, "mail a@b.c", "x", 2)], "doc_id long, text string, `odd.name` string, pii_base int")
    assert [tuple(r) for r in pii.redact(docs).collect()] == [(1, "mail [EMAIL]", "x", 2)] and pii.redact(docs).columns == docs.columns


BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
AT = r" ?[(\[{](?i:at)[)\]}] ?| (?i:at) "
DOT = r" ?[(\[{](?i:dot)[)\]}] ?| (?i:dot) "


def plain_candidates(text):
    """(kind, start, end, features, weak label, touches a rule span) of everything that is proposed in a text."""
    rules = [(a, b) for _, a, b in base(text)]
    touched = lambda a, b: any(x < b and a < y for x, y in rules)
    digits = lambda x: re.sub("[^0-9]", "", x)
    quad = lambda x: bool(re.fullmatch(rf"{BYTE}(?:\.{BYTE}){{3}}", x))

    def matches(pattern):
        """Matches with the text around them, up to 24 characters and no farther than the next match."""
        all_ = list(re.finditer(pattern, text))
        edges = [0, *(m.end() for m in all_)], [*(m.start() for m in all_), len(text)]
        return [(m, text[max(edges[0][k], m.start() - 24) : m.start()], text[m.end() : min(edges[1][k + 1], m.end() + 24)]) for k, m in enumerate(all_)]

    found = [("at", *m.span(), x, y) for m, x, y in matches(r"[^\s@]+@[^\s@]+")]
    for m, ahead, behind in matches(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9]){6,}"):
        found.append(("number", *m.span(), ahead, behind))
        groups = [(g.start() + m.start(), g.end() + m.start()) for g in re.finditer("[0-9]+", m[0])]
        if len(groups) == 1 or len(digits(m[0])) <= 15:
            continue
        for i, (a, _) in enumerate(groups):
            gap = text[groups[i - 1][1] if i else m.start() : a]
            room = 24 - (a - m.start())
            for j, (_, b) in enumerate(groups[i : i + 19], i):
                n = len(digits(text[a:b]))
                signed = n < 13 and gap[-1:] in ("+", "(")
                start = a - signed
                if not 7 <= n <= 19 or (start, b) == m.span() or touched(start, b):
                    continue
                before = (ahead[-room:] if room > 0 else "") + gap
                after = text[b : groups[j + 1][0] if j + 1 < len(groups) else m.end()]
                found.append(("number", start, b, before[:-1] if signed else before, after or behind))
    found += [("spelled", *m.span(), x, y) for m, x, y in matches(rf"[A-Za-z0-9._%+-]+(?:{AT})[A-Za-z0-9-]+(?:(?:{DOT}|\.)[A-Za-z0-9-]+)+")]
    out = []
    for form, a, b, before, after in found:
        x, n = text[a:b], len(digits(text[a:b]))
        number = form == "number"
        size = next(k for k, top in enumerate((7, 9, 12, 16, 20, 40, 10**9)) if n < top) if number else 0
        marks = (r"[(\[{](?i:at)[)\]}]", DOT) if form == "spelled" else (r"[()]", r"[ -]")
        dots = x.count(".")
        passes = number and 12 <= n <= 19 and luhn(digits(x))
        domain = 0 if number else 2 if re.search(rf"(?:@.*\.|{AT}).*?[A-Za-z]{{2,}}[.,;:!?)]*$", x) else 1 if re.search(r"@[^@]*\.", x) else 0
        cue = bool(re.search(pii.CUES, before))
        glued = bool(re.search(r"\w$", before) or re.search(r"^\w", after))
        features = [pii.FORMS[form], size, *(int(bool(re.search(k, x))) for k in marks), 0 if dots == 0 else 2 if dots == 3 else 1, int(passes), int(number and quad(x)), int(glued), int(cue), domain]
        plain = False
        if form == "spelled" and re.search(rf"{marks[0]}|{DOT}", x):
            plain = bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", re.sub(DOT, ".", re.sub(AT, "@", x))))
        if number:
            plain = 16 <= n <= 19 and luhn(digits(x))
        kind = "email" if not number else "ip" if re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", x) else "card" if n >= 13 else "phone"
        out.append((kind, a, b, tuple(features), plain or touched(a, b), touched(a, b)))
    return out


def test_added_spans_equal_a_plain_version(spark):
    import random

    rnd = random.Random(9)
    number = lambda k: "".join(rnd.choices("0123456789", k=k))
    pieces = [
        lambda: f"mail ann{number(2)}@mail.example.org", lambda: f"call +1 ({number(3)}) 555-{number(4)}", lambda: f"({number(3)}) 555-{number(4)}", lambda: number(16), lambda: f"{number(4)} {number(4)} {number(4)} {number(4)} {number(8)}",
        lambda: "bob (at) site dot com", lambda: "carl at home.now", lambda: f"{number(2)}.{number(2)}.{number(1)}.{number(3)}", lambda: "plain words here", lambda: f"4111111111111111 {number(9)}", lambda: f"id {number(7)}", lambda: "x@y",
    ]
    texts = [", ".join(rnd.choice(pieces)() for _ in range(rnd.randint(1, 6))) for _ in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marked = {r.doc_id: r for r in pii.with_spans(docs).collect()}
    counts = {}
    for k, text in enumerate(texts):
        wanted = sorted(plain_candidates(text))
        got = sorted((c.kind, c.start, c.end, tuple(pii.features_of(c.pattern)), c.good, c.hit) for c in marked[k].pii_candidates)
        assert got == wanted, text
        for c, features in ((c, pii.features_of(c.pattern)) for c in marked[k].pii_candidates):
            key = (c.pattern, c.good, marked[k].pii_apart)
            counts[key] = counts.get(key, 0) + 1
    chooser = pii.fit_chooser([(*k, n) for k, n in sorted(counts.items())])
    added = 0
    for r in pii.find_personal_data(docs).collect():
        spans = base(texts[r.doc_id])
        for kind in pii.KINDS:
            end = 0
            for a, b in sorted(((a, b) for k, a, b, f, _, hit in plain_candidates(texts[r.doc_id]) if k == kind and not hit and chooser.score(list(f)) >= chooser.threshold), key=lambda s: (s[0], -s[1])):
                if a >= end:
                    spans.append((kind, a, b))
                    end, added = b, added + 1
        spans.sort(key=lambda s: (pii.KINDS.index(s[0]), s[1], s[2]))
        assert r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in spans), texts[r.doc_id]
    assert added > 20
