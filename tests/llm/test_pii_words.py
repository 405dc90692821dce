import random

from threadloom.llm import pii


def test_ordinary_words_do_not_depend_on_the_size_of_the_table(make_turns):
    r = random.Random(3)
    vocab = ["word" + "".join(r.choice("abcdef") for _ in range(6)) for _ in range(400)]
    texts = [" ".join(r.sample(vocab, 4)) for _ in range(6000)]
    texts[17] = texts[17] + " seldom"
    few, many = (make_turns([{"text": t} for t in x]) for x in (texts, texts * 3))
    want = set(vocab)
    assert pii.ordinary_words(few, {"ada"}, {"lom"}) == pii.ordinary_words(many, {"ada"}, {"lom"}) == want
    assert pii.ordinary_words(make_turns([{"text": None}, {"text": "Ada Lom came"}] * 5), {"ada"}, {"lom"}) == {"came"}


def test_every_word_of_a_text_is_decoded():
    """Also where nothing near looks like an item."""
    tagger = pii.Tagger()
    words = {"the", "report", "was", "open", "today", "signed", "by", "and", "kept"}
    find = pii.Finder(tagger, {"ada"}, {"lom"}, words)
    calls = []
    viterbi = tagger.crf.viterbi
    tagger.crf.viterbi = lambda em, sizes: calls.append(int(sizes.sum())) or viterbi(em, sizes)
    text = "the report was open today signed by Xaveria Quillon and kept"
    find([text, None, "", "the report was open"])
    assert calls == [15]
    tagger.crf.viterbi = viterbi
    for t in ("Dr. Xaveria Quillon checked the report", "the report was signed by Xaveria Quillon today", "Mrs Xaveria Quillon called"):
        assert [(t[a:b], k) for a, b, k in find([t])[0]] == [("Xaveria Quillon", "person_name")]
