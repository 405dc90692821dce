import hashlib
import hmac
import math
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from threadloom.functions import scrub, text
from threadloom.sources.blobs import decode_body


def one(spark, value, fn, schema="text string"):
    return spark.createDataFrame([(value,)], schema).select(fn(F.col("text")).alias("x")).first()["x"]


def test_thread_bucket_pinned(spark):
    assert one(spark, "chat-7", text.thread_bucket) == 44
    assert one(spark, "thread-0", text.thread_bucket) == 19
    assert one(spark, None, text.thread_bucket) is None


@pytest.mark.parametrize("raw,want", [("\t a b  ", "a b"), (" x\x1f", "x"), ("", ""), (None, None)])
def test_trim_is_unicode(spark, raw, want):
    assert one(spark, raw, text.trim_u) == want


def test_looks_pasted_edges(spark):
    p = lambda t: one(spark, t, lambda c: text.looks_pasted(c, text.strip_fences(c)))
    assert not p("x" * 8000) and p("x" * 8001)
    half = "y" * 20 + "```" + "z" * 14 + "```"
    assert len(half) == 40 and not p(half) and p("y" * 19 + "```" + "z" * 15 + "```")


def test_tags_need_their_own_end(spark):
    t = "a<system-reminder>x\ny</system-reminder>b<command-name>c</command-name>d<command-name>e</command-message>f"
    assert one(spark, t, text.strip_tags) == "abd<command-name>e</command-message>f"


def test_strip_quoted(spark):
    body = "hello\n> old\nbye\n-- \nname\n"
    assert one(spark, body, text.strip_quoted) == "hello\nbye"
    assert one(spark, "new\nOn Monday, A wrote:\n> x", text.strip_quoted) == "new"


def test_words_match_a_model(spark):
    r = random.Random(3)
    alphabet = "aB.,;é Ⓐ  \t'\"—-x1٣"
    rows = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 25))) for _ in range(300)]
    got = spark.createDataFrame(list(enumerate(rows)), "i int, text string").select("i", text.words(F.col("text")).alias("w"), text.n_upper(F.col("text")).alias("u"), text.n_symbols(F.col("text")).alias("s"), text.n_punctuation(F.col("text")).alias("p")).collect()
    for g in got:
        t = rows[g["i"]]
        model = [w for w in (w.lower().strip(text.PUNCTUATION) for w in t.split()) if w]
        assert g["w"] == model, t
        assert g["u"] == sum(c.isupper() for c in t)
        assert g["s"] == sum(unicodedata.category(c) == "So" for c in t)
        assert g["p"] == sum(c in text.PUNCTUATION for c in t)


def test_question_shape(spark):
    assert one(spark, "What does Foo2 cost in Berlin?", text.question_shape) == "what does cost in"


def test_apple_time(spark):
    f = lambda v: str(one(spark, v, text.apple_time, "text bigint"))
    assert f(0) == f(None) == "2001-01-01 00:00:00" and f(60) == "2001-01-01 00:01:00"
    assert f(86_400_000_000_000) == "2001-01-02 00:00:00"


def test_wilson(spark):
    d = spark.createDataFrame([(0, 0), (5, 10), (10, 10)], "k bigint, n bigint")
    lo, hi = text.wilson(F.col("k"), F.col("n"))
    got = [(r[0], r[1]) for r in d.select(lo, hi).collect()]
    assert got[0] == (0.0, 1.0) and got[2][1] == pytest.approx(1.0)
    assert got[1][0] == pytest.approx(0.236593, abs=1e-5) and got[1][1] == pytest.approx(0.763407, abs=1e-5)
    with pytest.raises(Exception):
        spark.createDataFrame([(3, 2)], "k bigint, n bigint").select(lo).collect()


@pytest.mark.parametrize("t,want", [
    ("123-45-6789", "confidential"), ("123‑45‑6789", "confidential"), ("12​3-45-6789", "confidential"), ("call 12345678", "open"), ("123456789", "confidential"), ("٣٣٣٣٣٣٣٣٣", "confidential"),
    ("12-3456789", "confidential"), ("1234 5678 9012", "confidential"), ("acct no. x", "confidential"), ("the account notes", "open"), ("Routing #", "confidential"), ("account: 1234", "confidential"), ("account 123", "open"), ("", "open"),
])
def test_classify(spark, t, want):
    assert scrub.classify(spark.createDataFrame([(t, "mail")], "text string, source string")).first()["tier"] == want


def test_classify_by_source_and_null(spark):
    d = spark.createDataFrame([("x", " Karbon_notes "), ("x", "karbonx")], "text string, source string")
    assert [r["tier"] for r in scrub.classify(d).orderBy("source").collect()] == ["confidential", "open"]
    with pytest.raises(Exception):
        scrub.classify(spark.createDataFrame([(None, "mail")], "text string, source string")).collect()


def test_redact(spark):
    token = "Zx9Qw8Er7Ty6Ui5Op4As3Df2"
    rows = [("plain",), (f"key {token} end",), ("AKIA" + "ABCDEFGH12345678",), ("a" * 30,), (None,)]
    d = scrub.redact(spark.createDataFrame(rows, "text string"), null_error=False)
    got = {r["text"]: r["redacted"] for r in d.collect()}
    assert got == {"plain": "plain", f"key {token} end": "key [REDACTED] end", rows[2][0]: "[REDACTED]", "a" * 30: "a" * 30, None: None}
    assert all(scrub.redact_text(x) == x for x in got.values() if x)


def test_entropy_expression(spark):
    for t in ("aabb", "abcdefgh", "a", "é€é"):
        assert one(spark, t, scrub.entropy_of) == pytest.approx(scrub.entropy(t), abs=1e-9)


def test_identity(spark):
    d = spark.createDataFrame([("Ann Bo and ANN bo, éAnn Bo, Ann",)], "text string")
    got = d.select(scrub.scrub_identity(F.col("text"), ["Ann Bo", "Ann", " a "], r"$1\x")).first()[0]
    assert got == r"$1\x and $1\x, éAnn Bo, $1\x"
    assert d.select(scrub.scrub_identity(F.col("text"), ["ab"], "x")).first()[0].startswith("Ann")


def test_pseudonym_is_hmac(spark):
    for key in (b"k", b"x" * 100):
        d = spark.createDataFrame([("+99", False), ("me", True), ("ünï", False)], "author_id string, is_subject boolean")
        got = {r["author_id"]: r["author_out"] for r in scrub.pseudonymize(d, key).collect()}
        want = lambda s: "P-" + hmac.new(key, s.encode(), hashlib.sha256).hexdigest()[:12]  # noqa: E731, B023
        assert got == {"+99": want("+99"), "me": "me", "ünï": want("ünï")}
        assert scrub.pseudonym("+99", key) == want("+99")
        assert {r["raw"] for r in scrub.identity_map(d, key).collect()} == {"+99", "ünï"}


def test_decode_body():
    head = b"\x04\x0bstreamtypedNSString\x01\x94\x84\x01+"
    assert decode_body(head + b"\x05hello\x86") == "hello"
    long = "x" * 300
    assert decode_body(head + b"\x81" + (300).to_bytes(2, "little") + long.encode()) == long
    assert decode_body(head + b"\x82" + (300).to_bytes(4, "little") + long.encode()) == long
    assert decode_body(head + b"\x09hello") is None and decode_body(b"") is None and decode_body(None) is None and decode_body(head + b"\x02\xff\xff") is None


def test_regexes_are_fixed_text():
    assert all(re.compile(p) for p in scrub.SECRETS.values()) and math.isclose(scrub.ENTROPY, 3.9)
