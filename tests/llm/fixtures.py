"""Small document tables with every awkward case, and the text they share."""

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew strong potions near an old mill by the river".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + k * k + k * seed) % len(WORDS)] + ("." if k % 11 == 10 else "") for k in range(n))


PII = (
    "write to a.b@c-d.example.org, or a@b.c_d@e.f; call +1 (152) 555-8590. ip 10.0.0.255 not 1.2.3.256 or 1.2.3.4.5.6.7.8 "
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, +12 34, é日 4111111111111111 x@y.z"
)

TEXTS = [
    None,
    "",
    " ",
    "a",
    "two words",
    prose(1, 200),
    prose(1, 200),
    prose(1, 200).replace("lazy", "sleepy"),
    prose(2, 40).upper(),
    "x" * 5000,
    "héllo wörld — 日本語 テスト 😀 " * 30,
    PII,
    PII + "\n" + PII,
    "don't 's 'll we're\n\n  spaces\t\ttabs  ",
    "<|endoftext|>between<|endoftext|>",
    "1" * 40 + " " + "9.9.9.9 " * 5,
    "@@@ a@ @b + +1 ...",
    "\x00\x01\x02 control",
    prose(3, 30_000),
]


def documents(spark, texts=TEXTS):
    """Rows with ties, repeats, a null id, and extra columns whose names clash with the operators' own."""
    rows = [(k, t, "en", "src", None, "x", 1.0) for k, t in enumerate(texts)]
    rows += [(5, texts[5] if len(texts) > 5 else "t", "en", "src", 1, "x", 2.0), (None, prose(9, 20), None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string, length double")


def empty(spark):
    return documents(spark).where("false")


def pairs(df):
    """Rows of a frame as sorted tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
