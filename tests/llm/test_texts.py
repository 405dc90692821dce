import json
import os
import random
import re
import unicodedata
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from threadloom.llm import language, leakage, mail, pii, threads
from threadloom.llm.crf import CRF

from .conftest import T0

NAMES = "contact_id bigint, given_name string, surname string, note string"


def test_crf_learns_a_chain():
    r = random.Random(1)
    seqs, gold = [], []
    for _ in range(120):
        s = [r.choice("ab") for _ in range(r.randint(1, 9))]
        seqs.append([(x,) for x in s])
        gold.append(["x" if "a" in s[: i + 1] else "y" for i in range(len(s))])
    m = CRF(["x", "y"]).fit(seqs, gold, rounds=120)
    import numpy as np

    em = np.concatenate([np.stack([m.row(f) for f in s]) for s in seqs])
    got = m.viterbi(em, np.array([len(s) for s in seqs]), cells=40)
    assert [m.labels[i] for i in got] == [g for s in gold for g in s]
    assert m.row(("never seen",)).tolist() == [0, 0]


@pytest.fixture(scope="module")
def finder():
    return pii.Finder(pii.Tagger(), {"ada", "bela"}, {"holmqvist"}, {"the", "was", "open", "table", "about", "asked", "see"})


@pytest.mark.parametrize("t,want", [
    ("write to ada.lind+x@mail.example about it", {("email", "ada.lind+x@mail.example")}), ("reach bela [dot] roth [at] post [dot] example now", {("email", "bela [dot] roth [at] post [dot] example")}), ("call me on (416) 555-0107.", {("phone", "(416) 555-0107")}),
    ("tel +44 20 7946\n0555", {("phone", "+44 20 7946 0555")}), ("my ssn is 937-11-4185", {("id_number", "937-11-4185")}), ("order 2287-58-7213 was open", set()), ("invoice 421537637", set()), ("commit b5188a3defbc, build 7.30.265, host 192.0.2.153", set()),
    ("meet at 61 West Rosen Drive.", {("street_address", "61 West Rosen Drive")}), ("the flat is at 233 Korva St., third floor", {("street_address", "233 Korva St.")}), ("we moved to Lindenstraße 14", {("street_address", "Lindenstraße 14")}),
    ("ask Ada Holmqvist about the table", {("person_name", "Ada Holmqvist")}), ("Holmqvist, Ada opened the table", {("person_name", "Holmqvist, Ada")}), ("Hi Ada,\n\nthe table was open", set()), ("@bela will see the table", set()), ("", set()), (None, set()), ("Date: 26/04/2026 00:24", set()),
])
def test_items(finder, t, want):
    got = {(k, pii._BREAK.sub(" ", t[a:b])) for a, b, k in finder([t])[0]}
    assert got == want


def test_items_held_out(finder):
    """Recall and precision over labelled rows that were not trained on."""
    rows, gold, given, sur, ordinary = pii.training_rows(400, seed=77)
    f = pii.Finder(finder.tagger, given, sur, ordinary)
    hit = found = true = 0
    for cs, y in zip(rows, gold):
        text = " ".join(cs)
        spans, at = [], 0
        for c, lab in zip(cs, y):
            if lab[0] == "B":
                spans.append([at, at + len(c), lab[2:]])
            elif lab[0] == "I" and spans:
                spans[-1][1] = at + len(c)
            at += len(c) + 1
        got = f([text])[0]
        true += len(spans)
        found += len(got)
        hit += sum(any(a < q and b > p and k == z for a, b, k in got) for p, q, z in spans)
    assert hit / true > 0.95 and found <= true * 1.08


def test_redaction_keeps_the_rest(spark, make_turns):
    c = spark.createDataFrame([(1, "Ada", "Holmqvist", None), (2, None, None, None)], NAMES)
    s = spark.createDataFrame([("s", "Bela Roth"), ("z", None)], "subject_id string, display_name string")
    t = make_turns([{"text": x} for x in ("call me on (416) 555-0107, ok?\n", None, "", "plain", "ask Ada Holmqvist; ask Ada Holmqvist")])
    got = {r["turn_id"]: (r["n_items"], r["text"]) for r in pii.redacted(t, c, s).collect()}
    assert got == {1: (1, "call me on [PHONE], ok?\n"), 2: (0, None), 3: (0, ""), 4: (0, "plain"), 5: (2, "ask [NAME]; ask [NAME]")}
    assert {tuple(r) for r in pii.personal_items(t, c, s).collect()} == {(1, "phone", "(416) 555-0107"), (5, "person_name", "Ada Holmqvist")}
    assert pii.personal_items(t.limit(0), c.limit(0), s.limit(0)).count() == 0


MAIL = """Hi Bela,

the table was open today. On the phone the vendor wrote: it is gone.

> an old line
new again

Best regards,
Ada
--
Ada Lind
T: +1 212 555 0147

Sent from my phone

This message and any attachment are confidential and intended only for
the person named above.

On 15/08/2024 12:55, Bela Roth <bela@post.example>
wrote:
> old
>
> older"""


def test_mail_lines(make_turns):
    t = make_turns([{"text": MAIL}, {"text": None}, {"text": " \n "}, {"text": "only new words here, nothing else at all."}, {"text": MAIL, "source": "imessage"}, {"text": MAIL.replace("\n", "\r\n"), "source": " MAIL"}])
    got = mail.foreign_lines(t).collect()
    lines = lambda i: [r["line_no"] for r in sorted(got, key=lambda r: r["line_no"]) if r["turn_id"] == i]
    text = MAIL.split("\n")
    want = [i for i, x in enumerate(text, 1) if x.strip() and (i == 5 or i >= 8)]
    assert lines(1) == want == lines(6) and {r["turn_id"] for r in got} == {1, 6}
    new = {r["turn_id"]: r["new_text"] for r in mail.new_text(t).collect()}
    assert new[1] == "Hi Bela,\n\nthe table was open today. On the phone the vendor wrote: it is gone.\n\nnew again" and new[2] == new[3] == "" and 5 not in new and new[4].startswith("only")
    assert mail.foreign_lines(t.limit(0)).count() == 0


def test_mail_held_out():
    m = mail.fit()
    import numpy as np

    bad = n = 0
    for text, gold in mail.training_mails(200, seed=99):
        f = mail.line_features(text)[1]
        got = m.viterbi(np.stack([m.row(x) for x in f]), np.array([len(f)]))
        bad += sum((m.labels[a] == "new") != (b == "new") for a, b in zip(got, gold))
        n += len(gold)
    assert bad / n < 0.01


def envs(spark, rows):
    return spark.createDataFrame([("s", s, i, T0 + timedelta(minutes=m), T0, p, 1) for s, i, m, p in rows], "subject_id string, source string, source_id string, ts timestamp, ingested_at timestamp, payload string, id int")


def test_threads(spark, make_turns):
    ai = lambda th, who, t, up=None: json.dumps({"text": t, "conversation_uuid": th, "sender": who, "parent_message_uuid": up})
    rows = [
        ("claude_ai", "a1", 5, ai("A", "human", "q")), ("claude_ai", "a2", 1, ai("A", "assistant", "r", "a1")), ("claude_ai", "a3", 7, ai("A", "human", "more", "a2")), ("claude_ai", "a1", 5, ai("A", "human", "q")),
        ("claude_ai", "b1", 0, ai("B", "human", "q")), ("claude_ai", "b2", 1, ai("B", "assistant", " ​￼")),
        ("claude_ai", "c1", 0, ai("C", "human", "q")), ("claude_ai", "c2", 1, ai("C", "assistant", "r", "zz")),
        ("claude_ai", "d1", 0, "{'text': 'x'}"), ("claude_ai", "d2", 1, ai("D", "assistant", "r")),
        ("claude_ai", "e1", 0, ai("E", "human", "q", "e2")), ("claude_ai", "e2", 1, ai("E", "assistant", "r", "e1")),
        ("claude_ai", "x1", 0, ai("no turn", "human", "q")), ("mail", "m", 0, "{"), ("claude_ai", "f1", 0, '{"text": "cut'), ("claude_ai", "g1", 0, "null"), ("claude_ai", "h1", 0, '[{"text": "x"}]'), ("claude_ai", "k1", 0, ai("K", "human", "q") + " {}"),
    ]
    e = envs(spark, rows)
    turn = lambda th, i, t="q": {"source": "Claude_AI", "thread_id": th, "source_id": i, "text": t, "ts": T0}
    t = make_turns([turn("A", "a1"), turn("A", "a3", "more"), turn("A", "a3", "more"), turn("B", "b1"), turn("C", "c1"), turn("D", "d1"), turn("E", "e1"), turn("F", "f1"), turn("G", "g1"), turn("H", "h1"), turn("K", "k1"), {"source": "claude_ai", "thread_id": None}, {"source": "mail", "thread_id": "M"}, turn("Z", "none")])
    v = {r["thread_id"]: r for r in threads.thread_verdicts(t, e).collect()}
    assert {k for k, r in v.items() if r["dropped"]} == {"B", "C", "D", "F", "G", "H", "K", "Z"} and set(v) == {*"ABCDEFGHKZ"}
    assert v["E"]["n_cyclic"] == 2 and v["C"]["n_orphans"] == 1
    c = threads.conversations(t, e).collect()
    a = sorted((r for r in c if r["thread_id"] == "A"), key=lambda r: r["seq"])
    assert [(r["seq"], r["role"], r["text"], r["depth"]) for r in a] == [(1, "subject", "q", 0), (2, "assistant", "r", 1), (3, "subject", "more", 2)]
    assert {r["thread_id"] for r in c} == {"A", "E"}
    assert threads.thread_verdicts(t.limit(0), e).count() == 0 and threads.conversations(t, e.limit(0)).count() == 0


def test_long_chain(spark, make_turns):
    rows = [("chatgpt", f"n{i}", i % 3, json.dumps({"text": "t", "conversation_id": "L", "role": "user" if i % 2 else "assistant", "parent": f"n{i - 1}" if i else None})) for i in range(70)]
    t = make_turns([{"source": "chatgpt", "thread_id": "L", "source_id": "n1", "text": "t"}])
    c = sorted(threads.conversations(t, envs(spark, rows)).collect(), key=lambda r: r["seq"])
    assert [r["source_id"] for r in c] == [f"n{i}" for i in range(70)] and [r["depth"] for r in c] == list(range(70))


def plain_words(t):
    t = "".join(c for c in t if unicodedata.category(c) != "Cf")
    return re.findall(r"[^\W_]+", "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn").lower())


def test_leaks_match_brute_force(spark):
    r = random.Random(3)
    vocab = ["un", "été", "größe", "x1", "two", "three", "Four"]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(5, 40)))) for i in range(25)] + [(90, None), (91, "")]
    docs = [(i, " ".join(r.choice(vocab) for _ in range(40)) + " " + (items[r.randrange(25)][1][r.randrange(5) :]).replace("e", "e​") + ". " + "z " * 3) for i in range(40)] + [(100, None), (101, ""), (102, items[0][1].upper() * 3)]
    p = spark.createDataFrame([(i, q, "n") for i, q in items], "item_id bigint, question string, doc_id string")
    d = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id bigint, text string, item_id int")
    want = {}
    for i, q in items:
        a = plain_words(q or "")
        for j, t in docs:
            b = plain_words(t or "")
            best = 0
            run = [0] * (len(b) + 1)
            for x in a:
                new = [0] * (len(b) + 1)
                for k, y in enumerate(b, 1):
                    if x == y:
                        new[k] = run[k - 1] + 1
                        best = max(best, new[k])
                run = new
            if best >= 12:
                want[i, j] = best
    got = {(x["item_id"], x["doc_id"]): x["n_words"] for x in leakage.leaks(d, p).collect()}
    assert got == want and len(want) > 10
    assert leakage.leaks(d, p.limit(0)).count() == 0 and leakage.leaks(d.limit(0), p).count() == 0


def test_leaks_in_passes_and_removal(spark, monkeypatch):
    q = ["one two three four five six seven eight nine ten eleven twelve thirteen", "aa bb cc dd ee ff gg hh ii jj kk ll mm nn"]
    p = spark.createDataFrame(list(enumerate(q)), "item_id bigint, question string")
    d = spark.createDataFrame([(1, f"Before, {q[0].title()} — after. {q[1]}!"), (2, "nothing")], "doc_id bigint, text string")
    monkeypatch.setattr(leakage, "PASS_WORDS", 5)
    assert {(r["item_id"], r["doc_id"]) for r in leakage.leaks(d, p).collect()} == {(0, 1), (1, 1)}
    assert leakage.without_leaks(d, p).first().asDict() == {"doc_id": 1, "n_spans": 2, "n_words_removed": 27, "text": "Before,  — after. !"}
    assert leakage.without_leaks(d, p, max_words=99, max_coverage=1.0).count() == 0


SAY = {
    "en": "the weather was very nice and we went home before it started to rain again because nobody wanted to wait".split(), "de": "das wetter war sehr schön und wir gingen nach hause bevor es wieder anfing zu regnen weil niemand warten wollte".split(),
    "fr": "le temps était très beau et nous sommes rentrés avant que la pluie recommence parce que personne ne voulait attendre".split(), "es": "el tiempo era muy bueno y nos fuimos a casa antes de que empezara otra vez la lluvia porque nadie quería esperar".split(),
    "it": "il tempo era molto bello e siamo tornati a casa prima che ricominciasse la pioggia perché nessuno voleva aspettare".split(), "pt": "o tempo estava muito bom e fomos para casa antes que começasse a chover outra vez porque ninguém queria esperar".split(),
    "nl": "het weer was erg mooi en we gingen naar huis voordat het weer begon te regenen omdat niemand wilde wachten".split(),
}


def test_languages(spark):
    r = random.Random(8)
    say = lambda lang, n=30: " ".join(r.choice(SAY[lang]) for _ in range(n)).capitalize() + "."
    rows = [(i, say(x), x, 1) for i, x in enumerate(list(SAY) * 12)]
    rows += [(200, say("fr"), None, 1), (201, say("en"), "DE_de", 1), (202, say("nl"), "NL-be", 1), (203, say("de") + "\n\n" + say("es"), "de", 1), (204, "9005 81f7f210 86609 0.6791\n" * 30, "en", 1), (205, "7749 cb8ce7f7 915676\n" * 30, "und", 1), (206, None, None, 1), (207, "", "en", 1), (208, say("it"), "unknown", 1), (209, say("pt", 4000), "xx", 1), (210, say("en") + " " + say("fr", 6), "en", 1)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, seq int")
    got = {tuple(x) for x in language.wrong_labels(d).collect()}
    assert got == {(200, "fr"), (201, "en"), (203, "de"), (203, "es"), (204, "und"), (206, "und"), (207, "und"), (208, "it"), (209, "pt")}
    s = language.stretches(d).where("doc_id = 203").orderBy("seq").collect()
    assert [x["lang"] for x in s] == ["de", "es"] and all(0 < x["confidence"] <= 1 for x in s) and sum(x["n_words"] for x in s) == 60
    assert language.wrong_labels(d.limit(0)).count() == 0


def test_model_is_a_distribution():
    from collections import Counter

    import numpy as np

    m = language.KneserNey([Counter({"abab": 3, "abc": 2, "b": 1}), Counter({"xyz": 2, "": 1})])
    s = m.scores(["abab", "xyz", "q"])
    assert s[0, 0] > s[0, 1] and s[1, 1] > s[1, 0] and np.isfinite(s).all() and (s <= 0).all()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
@pytest.mark.parametrize("name", ["p1_split", "p2_mix", "p4_found", "p6_found", "p7_conversations", "p7_found", "p8_pack", "p9_found", "p10_found"])
def test_queries_run(spark, name):
    import __spark_entry__ as entry

    d = entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert d.count() >= 0 and F.lit(1) is not None
