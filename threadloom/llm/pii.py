"""Problem 4: personal items in free text, found by a conditional random field over word shapes."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.crf import CRF
from threadloom.llm.mail import BANNERS, CLOSINGS, FIELDS, GREETINGS, PROGRAM
from threadloom.session import collect_bounded

KINDS = ("email", "phone", "id_number", "street_address", "person_name")
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "street_address": "[ADDRESS]", "person_name": "[NAME]"}
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
TRAIN_ROWS = 3500
#: An ordinary word stands in this many texts at least, and in this part of all texts, so the size of the table does not matter.
ORDINARY, ORDINARY_SHARE = 4, 0.0003

# Words around personal items and around numbers that are none.
PHONE_WORDS = set("call tel tel. telephone phone mobile cell text sms fax ring dial number desk line whatsapp handy telefon portable m t f reach".split())
ID_WORDS = set("ssn social security passport tax taxpayer insurance national nino id nin identity personal licence license steuer-id ausweis dni nif bsn tin pass".split())
PLAIN_WORDS = set("order invoice build commit host total room version ticket issue pr ref reference release port page item sku batch case level".split())
TITLES = set("dr mr mrs ms miss prof professor herr frau mme mlle sr sra sig dott sir".split())
STREETS = set("street st road rd avenue ave lane ln drive dr court ct boulevard blvd way close square sq terrace place pl row crescent hill".split())
STREETS_BEFORE = set("rue via calle rua avenida avenue piazza plaza place boulevard chemin corso viale paseo travessa allée".split())
STREET_ENDS = ("straße", "strasse", "weg", "gasse", "platz", "allee", "damm", "laan", "straat", "gracht", "plein")
DOTTED = ("st", "rd", "ave", "ln")

CHUNK = re.compile(r"[^\s;,]+(?:,(?=\d)[^\s;,]+)*[;,]*|\r?\n\s*")
FORMAL = {w.lower() for x in (*GREETINGS, *CLOSINGS, *FIELDS, *BANNERS, *PROGRAM) for w in re.findall(r"[^\W\d_]+", x)}
LEAD, TRAIL = "\"'“”‘’«<([{*_|-", "\"'”’»>)]}*_,;:.!?-"
_AT = re.compile(r"(?i)^[\[({<]\s*at\s*[\])}>]$")
_DOT = re.compile(r"(?i)^[\[({<]\s*(?:dot|punkt|point)\s*[\])}>]$")
_AREA = re.compile(r"^\(\+?\d{1,5}\)")
_DASH = re.compile(r"[‐-―−]")
_EMAIL = re.compile(r"[\w.+%'-]*\w@[\w-]+(?:\.[\w-]+)+")
_RUN = re.compile(r"\d+|[A-Z]+|[^\W\d_]+|.", re.S)
_DIGIT = re.compile(r"\d")


@lru_cache(200_000)
def core_span(chunk: str) -> tuple[int, int]:
    """Where the word itself begins and ends within a chunk."""
    if _AT.match(chunk) or _DOT.match(chunk):
        return 0, len(chunk)
    a, b = 0, len(chunk)
    if chunk.isspace():
        return b, b
    while b > a and chunk[b - 1] in TRAIL:
        b -= 1
    if _AREA.match(chunk):
        if b < len(chunk) and ")" not in chunk[:b]:
            b = chunk.index(")") + 1
    else:
        while a < b and chunk[a] in LEAD:
            a += 1
    for scheme in ("mailto:", "tel:"):
        if chunk[a:b].lower().startswith(scheme):
            a += len(scheme)
    return a, max(a, b)


class Forms(dict):
    """A chunk to the number of its form; a form is a tuple of features."""

    def __init__(self, given: set[str], surnames: set[str], ordinary: set[str]):
        super().__init__()
        self.given, self.surnames, self.ordinary = given, surnames, ordinary
        self.ids: dict[tuple[str, ...], int] = {}
        self.list: list[tuple[str, ...]] = []

    def __missing__(self, chunk: str) -> int:
        f = self.form(chunk)
        i = self.ids.get(f)
        if i is None:
            i = self.ids[f] = len(self.list)
            self.list.append(f)
        if len(self) > 500_000:
            self.clear()
        self[chunk] = i
        return i

    def form(self, chunk: str) -> tuple[str, ...]:
        if chunk.isspace():
            return ("gap",) if chunk.count("\n") > 1 else ("line",)
        a, b = core_span(chunk)
        w = chunk[a:b]
        tail = chunk[b:].strip("\"'”’»>)]}*_")
        out = []
        if tail:
            out.append("tail" + ("," if "," in tail else ";" if ";" in tail else ":" if ":" in tail else "."))
        if chunk[:1] in "<":
            out.append("angle")
        if chunk[:1] in ">|":
            out.append("mark")
        if not w:
            return (*out, "empty", chunk[:1])
        low = w.lower()
        if _AT.match(chunk):
            return (*out, "AT")
        if _DOT.match(chunk):
            return (*out, "DOT")
        if "@" in w:
            out.append("at" if _EMAIL.search(w) else "at-only" if w == "@" else "handle" if w[0] == "@" else "at-half")
            return tuple(out)
        if _DIGIT.search(w):
            shape = []
            for r in _RUN.findall(_DASH.sub("-", w)):
                shape.append(f"d{min(len(r), 12)}" if r[0].isdigit() else ("X" if r.isupper() else "x") + str(min(len(r), 3)) if r[0].isalpha() else r)
            s = "".join(shape[:9])
            out += ["digits", "n:" + s, f"len{min(15, sum(c.isdigit() for c in w))}"]
            if re.fullmatch(r"\d{1,4}[A-Za-z]?", w):
                out.append("house")
            if w[0] == "+":
                out.append("plus")
            return tuple(out)
        if re.fullmatch(r"[A-Za-z]", w) and chunk[b : b + 1] == ".":
            return ("initial", *(x for x in out if x != "tail."))
        if low in TITLES:
            out.append("title")
        if low in STREETS:
            out.append("street")
        if low in STREETS_BEFORE:
            out.append("street-before")
        if low.endswith(STREET_ENDS) and len(low) > 6:
            out.append("street-end")
        if low in ("north", "south", "east", "west"):
            out.append("side")
        for name, group in (("phone", PHONE_WORDS), ("id", ID_WORDS), ("plain", PLAIN_WORDS)):
            if low in group:
                out.append("k:" + name)
        out.append("upper" if w.isupper() and len(w) > 1 else "title-case" if w[0].isupper() else "lower-case" if low == w else "odd-case")
        if low in self.given:
            out.append("given")
        elif low in self.surnames:
            out.append("surname")
        if (low in self.ordinary or low in FORMAL) and low not in self.given:
            out.append("ordinary")
        elif w.replace("-", "").replace("'", "").isalpha() and low not in self.given:
            out.append("rare")
        if len(w) == 1:
            out.append("one")
        if "." in w:
            out.append("dots")
        if low in ("at", "dot", "no", "nr", "number", "is", "and", "on", "to", "the", "by", "with", "said", "will"):
            out.append("w:" + low)
        return tuple(out)


OFFSETS = (-3, -2, -1, 0, 1, 2, 3)


def _features(forms: list[tuple[str, ...]], i: int) -> tuple[str, ...]:
    """Features of word i and of its neighbours; those of neighbours two and three away only where they carry context."""
    out = []
    for o in OFFSETS:
        j = i + o
        f = forms[j] if 0 <= j < len(forms) else ("edge",)
        out += [f"{o}:{x}" for x in f]
    return tuple(out)


def training_rows(n: int = TRAIN_ROWS, seed: int = 11) -> tuple[list[list[str]], list[list[str]], set[str], set[str], set[str]]:
    """A labelled table made by rule: (chunks, labels, given names, surnames, ordinary words)."""
    r = random.Random(seed)
    given = "Ada Bela Cyril Doro Edda Falk Gesa Hanno Ivo Jutta Kuno Lale Merle Nino Oda Pia Runa Silke Timo Ulla Vera Wanda Xenia Yann Zora".split()
    syl = "ba bren cas dor eck far gar hal ib jor kel lom mar nor ost pel quin ras sol tur ulm ver wen yar zel".split()
    ends = ["berg", "son", "ini", "ez", "vic", "mann", "ard", "oux", "sen", "ley", "ova", "tti"]
    vocab = "the a our we they she he it is was can you please moved checked wrote sent found table report garden meeting plan ticket window draft server letter budget train sample house poem lens new old small cold quiet open late early dry local before near after today again slowly about and or for with when done keep safe goes mine said will see remembered opened imported bounced speaking signed met ask landlord form wants write cc login deliver flat place third floor box boxes finally twice nearby my this that here from to at by on in of as number".split()
    dg = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    dash = lambda: r.choice(["-", "-", "-", "‑", "–"])

    def surname() -> str:
        return ("".join(r.choice(syl) for _ in range(r.randint(1, 3))) + r.choice(ends)).capitalize()

    known = [surname() for _ in range(150)]
    rare = lambda: "".join(r.choice(syl) for _ in range(r.randint(2, 4)))

    def word() -> str:
        return rare() if r.random() < 0.07 else r.choice(vocab)

    def name() -> str:
        g = r.choice(given) if r.random() < 0.96 else surname()[:5].capitalize()
        s = r.choice(known) if r.random() < 0.5 else surname()
        k = r.random()
        out = f"{g} {s}" if k < 0.66 else f"{s}, {g}" if k < 0.8 else f"{g[0]}. {s}" if k < 0.95 else f"{g} {r.choice('ABEJM')}. {s}"
        c = r.random()
        return out.lower() if c < 0.12 and ". " not in out else out.upper() if c < 0.22 else out

    def phone() -> str:
        d = dash()
        return r.choice([
            f"+1 {dg(3)} 555 0{dg(3)}", f"({dg(3)}) 555{d}0{dg(3)}", f"{dg(3)}{d}555{d}0{dg(3)}", f"{dg(3)}.555.0{dg(3)}", f"1{d}{dg(3)}{d}555{d}0{dg(3)}", f"+1{dg(3)}5550{dg(3)}", f"1 {dg(3)} 555 0{dg(3)}",
            f"+44 20 7946 0{dg(3)}", f"020 7946 0{dg(3)}", f"+44 7700 900{dg(3)}", f"07700 900{dg(3)}", f"07700900{dg(3)}", f"+33 1 99 00 {dg(2)} {dg(2)}", f"01 99 00 {dg(2)} {dg(2)}", f"01.99.00.{dg(2)}.{dg(2)}",
            f"+49 30 23125 {dg(3)}", f"030/23125-{dg(3)}", f"030 23125{dg(3)}", f"+49 (0)30 23125-{dg(3)}", f"+34 6{dg(2)} {dg(3)} {dg(3)}", f"+39 06 {dg(4)} {dg(4)}", f"0{dg(3)}/{dg(6)}", f"+1 ({dg(3)}) 555-0{dg(3)}",
        ])

    def number() -> str:
        d = dash()
        L = lambda k: "".join(r.choice("ABCEGHJKLMNPRSTWXZ") for _ in range(k))
        return r.choice([
            f"{dg(3)}{d}{dg(2)}{d}{dg(4)}", f"{dg(3)}{d}{dg(2)}{d}{dg(4)}", f"{dg(3)} {dg(2)} {dg(4)}", dg(9), f"{L(2)}{dg(6)}{L(1)}", f"{L(2)} {dg(2)} {dg(2)} {dg(2)} {L(1)}", f"{dg(8)}{L(1)}", f"{L(2)}{dg(7)}", f"{L(1)}{dg(8)}", f"{L(1)}{dg(7)}", f"{dg(2)} {dg(3)} {dg(3)} {dg(3)}",
        ])

    def email() -> str:
        g, s = r.choice(given).lower(), surname().lower()
        local = r.choice([f"{g}.{s}", f"{g[0]}{s}", f"{s}_{g}", f"{g}{r.randint(1, 99)}", f"{g}.{s}+{r.choice(vocab)}"])
        dom = r.choice(["mail.example", "example.com", "studio.example.org", "post.example", "firm.test"])
        k = r.random()
        if k < 0.7:
            e = f"{local}@{dom}"
            return e.upper() if r.random() < 0.1 else e
        if k < 0.8:
            return f"{local} @ {dom}"
        at = r.choice(["[at]", "(at)", "{at}"])
        if k < 0.9:
            return f"{local} {at} {dom}"
        dot = r.choice(["[dot]", "(dot)"])
        return f"{local.replace('.', f' {dot} ')} {at} {dom.replace('.', f' {dot} ')}"

    def address() -> str:
        s, n = surname(), f"{r.randint(1, 399)}{r.choice(['', '', '', 'B', 'a'])}"
        side = r.choice(["", "", "", "West ", "North "])
        return r.choice([
            f"{n} {side}{s} {r.choice(['Street', 'Road', 'Lane', 'Drive', 'Court', 'Avenue', 'Blvd', 'Way', 'Close', 'Terrace'])}", f"{n} {side}{s} {r.choice(['Street', 'St.', 'Rd.', 'Ave.'])}", f"{s}{r.choice(['straße', 'weg', 'gasse', 'platz', 'laan'])} {n}",
            f"{n}{r.choice([',', ''])} {r.choice(['rue', 'rue', 'avenue', 'place'])} {r.choice(['', 'de ', 'du ', 'de la '])}{s}", f"{r.choice(['Via', 'Calle', 'Rua', 'Piazza'])} {s} {n}", f"{r.choice(['Calle', 'Via'])} {s}, {n}",
        ])

    say = {
        "email": ["write to {} about it", "cc {}, they know", "login is {}", "{} bounced again", "my new address is {}", "send it to {} please", "reach me under {}", "<{}>", "From: {}"],
        "phone": ["call me on {}", "tel {}", "new number: {}", "{} is my desk line", "text {} when done", "the plumber is at {} finally", "fax was {}, ignore it", "T: {}", "Mobile: {}", "m {}", "Tel. {}", "{}", "Desk 4\n{}", "Support\n{}", "{}\nDesk 2"],
        "id_number": ["my ssn is {}", "national insurance {}", "passport no {}", "tax id {} goes on the form", "the form wants your ID number: {}", "use {} for the budget", "{} is mine, keep it safe", "personal number {} (for the form)", "passport number {}", "SSN: {}"],
        "street_address": ["meet at {}", "we moved to {} finally", "my place: {}", "the flat is at {}, third floor", "meet at {}.", "we moved to {}.", "deliver the sample to {}", "{} is where it was", "I live in {} now"],
        "person_name": ["ask {} about the plan", "met {} nearby", "signed by {} today", "this is {} speaking", "my landlord is {}", "Dr. {} checked the report", "{} opened the table", "{}", "On 01.02.2024 um 12:09, {} wrote:", "{} <x.y@mail.example> wrote:", "From: {}", "Mrs {} called", "--\n{}\nAccounts", "-- \n{}\nDesk 3", "{}\nwrote:", "Kind regards,\n{}"],
    }
    plain = [
        lambda: f"order {dg(4)}-{dg(2)}-{dg(4)}", lambda: f"invoice {dg(9)}", lambda: f"invoice {dg(8)}", lambda: f"build {dg(1)}.{dg(2)}.{dg(3)}", lambda: "commit " + "".join(r.choice("0123456789abcdef") for _ in range(12)),
        lambda: f"total {dg(2)},{dg(3)}.{dg(2)}", lambda: f"host 192.0.2.{r.randint(1, 254)}", lambda: f"room {dg(3)} on Level {dg(1)}", lambda: f"on 20{dg(2)}-0{r.randint(1, 9)}-1{dg(1)}", lambda: f"on 1{dg(1)}.0{r.randint(1, 9)}.2024 at 1{dg(1)}:3{dg(1)}",
        lambda: f"@{r.choice(given).lower()} will see it", lambda: f"Hello {r.choice(given)},", lambda: f"Hi {r.choice(given)}!", lambda: f"{r.choice(given)} said so", lambda: f"Thanks, {r.choice(given)}", lambda: f"{r.choice(given)}, {r.choice(given)} and {r.choice(given)} came",
        lambda: f"the {surname()} Bridge page", lambda: "the Blue Lamp Cafe", lambda: f"git@origin:{rare()}", lambda: f"{r.choice(given).lower()} {r.choice(vocab)} {r.choice(vocab)}", lambda: f"a {r.choice(given).lower()} {r.choice(vocab)}", lambda: f"it took {dg(2)} days to open the {word()}",
        lambda: f"the {rare()} {r.choice(vocab)} is open", lambda: f"the entry about {surname()} {dg(3)} is old", lambda: f"ticket {dg(5)}", lambda: f"[1{dg(1)}:0{dg(1)}]: ok", lambda: f"version 2.{dg(1)}.{dg(1)}", lambda: f"see Desk {dg(1)}", lambda: f"Desk {dg(1)}\n{surname()}", lambda: f"Date: {r.randint(1, 28):02}/{r.randint(1, 12):02}/20{dg(2)} 1{dg(1)}:{r.randint(10, 59)}", lambda: f"Sent: {r.randint(1, 28):02}.{r.randint(1, 12):02}.20{dg(2)} um 0{dg(1)}:{r.randint(10, 59)}", lambda: f"On Mar 0{dg(1)}, 20{dg(2)}, at 0{dg(1)}:{r.randint(10, 59)} PM,", lambda: f"On {r.randint(1, 28):02}/{r.randint(1, 12):02}/20{dg(2)} 1{dg(1)}:{r.randint(10, 59)},", lambda: f"{r.choice(GREETINGS)} {r.choice(given)}", lambda: f"{r.choice(CLOSINGS).capitalize()},\n{r.choice(given)}", lambda: f"{dg(2)} summer boxes",
        lambda: f"Dear {r.choice(given)} -", lambda: f"{r.choice(['Besides', 'Frankly', 'Sadly'])} the {surname()} page", lambda: f"ask {r.choice(given)} about the plan", lambda: f"{r.choice(given).upper()} WILL SEE THE {r.choice(vocab).upper()}", lambda: f"{surname()} ist der {r.choice(vocab)}",
    ]
    make = {"email": email, "phone": phone, "id_number": number, "street_address": address, "person_name": name}
    rows, gold = [], []
    for _ in range(n):
        text, spans = "", []
        for _ in range(r.randint(2, 5)):
            k = r.random()
            sep = r.choice([" ", " ", ". ", ". ", "; ", ", ", "\n", "\n", "\n\n", "! "]) if text else ""
            text += sep
            if k < 0.45:
                kind = r.choice(KINDS)
                item, tpl = make[kind](), r.choice(say[kind]) if r.random() < 0.7 else r.choice(["{}", "{}", "{}.", "at {}", "the number of {} is odd"]) if kind != "id_number" else "{} is mine"
                if kind == "person_name" and "{} <x" in tpl:
                    mail = email().split(" ")[0]
                    tpl = tpl.replace("x.y@mail.example", mail if "@" in mail else "x.y@mail.example")
                at = text + tpl[: tpl.index("{}")]
                if " " in item and r.random() < 0.14:
                    cut = r.choice([i for i, c in enumerate(item) if c == " "])
                    item = item[:cut] + "\n" + item[cut + 1 :]
                spans.append((len(at), len(at) + len(item), kind))
                rest = tpl[tpl.index("{}") + 2 :]
                text = at + item + rest
                if "@" in rest and kind == "person_name":
                    m = _EMAIL.search(rest)
                    spans.append((len(at) + len(item) + m.start(), len(at) + len(item) + m.end(), "email"))
            elif k < 0.75:
                text += r.choice(plain)()
            else:
                s = " ".join(word() for _ in range(r.randint(3, 9)))
                text += s.capitalize() if r.random() < 0.5 else s.upper() if r.random() < 0.15 else s
        chunks, labels = [], []
        for m in CHUNK.finditer(text):
            lab = "O"
            for a, b, kind in spans:
                if m.start() < b and m.end() > a and (m.end() <= b or not m.group().isspace()):
                    lab = ("B-" if m.start() <= a else "I-") + kind
            chunks.append(m.group())
            labels.append(lab)
        rows.append(chunks)
        gold.append(labels)
    flagged = {x.lower() for x in known if r.random() < 0.6}
    return rows, gold, {g.lower() for g in given}, flagged, set(vocab)


class Tagger:
    """The fitted field as tables: per form and place in the window the scores of all labels."""

    def __init__(self, rows: int = TRAIN_ROWS):
        chunks, gold, given, surnames, ordinary = training_rows(rows)
        forms = Forms(given, surnames, ordinary)
        seqs = [[forms.form(c) for c in cs] for cs in chunks]
        self.crf = CRF(LABELS).fit([[_features(s, i) for i in range(len(s))] for s in seqs], gold, rounds=330, rate=0.15, parts=5)

    def table(self, forms: list[tuple[str, ...]]) -> np.ndarray:
        """(offsets, forms + edge, labels)."""
        every = [*forms, ("edge",)]
        return np.stack([np.stack([self.crf.row(tuple(f"{o}:{x}" for x in f)) for f in every]) for o in OFFSETS])


_KEEP_DOT = re.compile(r"(?i)^(?:" + "|".join(DOTTED) + r")$")


_DATE = re.compile(r"(?<!\d)(?:\d{1,2}([./-])\d{1,2}\1(?:19|20)\d\d|(?:19|20)\d\d-\d\d-\d\d)(?!\d)")


def _check(kind: str, item: str) -> bool:
    """Whether a span can be an item of its kind at all."""
    digits = sum(c.isdigit() for c in item)
    if kind == "email":
        e = re.sub(r"(?i)\s*[\[({<]\s*(?:dot|punkt|point)\s*[\])}>]\s*", ".", re.sub(r"(?i)\s*(?:[\[({<]\s*at\s*[\])}>]|@)\s*", "@", item))
        return bool(_EMAIL.fullmatch(e))
    if kind == "phone":
        return 7 <= digits <= 15 and not re.search(r"[A-Za-z]{2}", item) and not _DATE.search(item)
    if kind == "id_number":
        return 6 <= digits <= 13
    if kind == "street_address":
        return digits > 0 and any(c.isalpha() for c in item)
    return digits == 0 and not set("@<>|:") & set(item) and len(re.findall(r"[^\W\d_]+", item)) >= 2


class _Chunks:
    """The chunks of a text as (start, chunk), made as they are asked for."""

    def __init__(self, text: str):
        self.found = list(CHUNK.finditer(text))

    def __len__(self) -> int:
        return len(self.found)

    def __getitem__(self, i: int) -> tuple[int, str]:
        x = self.found[i]
        return x.start(), x.group()


class Finder:
    """Texts to items ``(start, end, kind)``, a batch at a time."""

    def __init__(self, tagger: Tagger, given: set[str], surnames: set[str], ordinary: set[str]):
        self.tagger, self.forms = tagger, Forms(given, surnames, ordinary)
        self.scores, self.kind_of = None, [x[2:] for x in LABELS]

    def _grow(self) -> None:
        n = len(self.forms.list)
        if self.scores is not None and self.scores.shape[1] == n + 1:
            return
        have = 0 if self.scores is None else self.scores.shape[1] - 1
        new = self.tagger.table(self.forms.list[have:])
        self.scores = new if self.scores is None else np.concatenate((self.scores[:, :-1], new), 1)

    def __call__(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        forms = self.forms
        per = [[forms[c] for c in CHUNK.findall(t)] if t else [] for t in texts]
        self._grow()
        lens = np.array([len(p) for p in per], np.int64)
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        # texts stand one after the other with edges between them
        gap = len(OFFSETS)
        edge = len(self.forms.list)
        flat = np.full(int(lens.sum()) + gap * (len(texts) + 1), edge, np.int64)
        firsts = np.cumsum(lens + gap) - lens
        for f, p in zip(firsts, per):
            flat[f : f + len(p)] = p
        where = np.flatnonzero(flat != edge)
        if not where.size:
            return out
        cut = np.concatenate(([True], np.diff(where) > 1))
        sizes = np.diff(np.concatenate((np.flatnonzero(cut), [where.size])))
        em = np.zeros((where.size, len(LABELS)), np.float32)
        for k, o in enumerate(OFFSETS):
            em += self.scores[k][flat[where + o]]
        lab = self.tagger.crf.viterbi(em, sizes)
        hit = np.flatnonzero(lab)
        if not hit.size:
            return out
        owner = np.searchsorted(firsts, where[hit], side="right") - 1
        begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        for s, e in zip(begin, np.concatenate((begin[1:], [hit.size]))):
            i = int(owner[s])
            self._spans(texts[i], where[hit[s:e]] - firsts[i], lab[hit[s:e]], out[i])
        return out

    def _spans(self, text: str, places, labs, out) -> None:
        m = _Chunks(text)
        groups: list[list[int]] = []
        kinds: list[str] = []
        for p, q in zip(places.tolist(), labs.tolist()):
            kind = LABELS[q][2:]
            if groups and LABELS[q][0] == "I" and kinds[-1] == kind and p == groups[-1][-1] + 1:
                groups[-1].append(p)
            else:
                groups.append([p])
                kinds.append(kind)
        parts = []
        for g, kind in zip(groups, kinds):
            while g and m[g[-1]][1].isspace():
                g.pop()
            while g and m[g[0]][1].isspace():
                g.pop(0)
            if not g or any(m[q][1].count("\n") > 1 for q in g if m[q][1].isspace()):
                continue
            parts += [(kind, part) for part in self._parts(kind, [(p, *m[p]) for p in g])]
        for kind, g in parts:
            if kind == "street_address":
                g = self._street_word(m, g)
            q = g[0][0] - 1
            while q >= 0 and m[q][1].isspace():
                q -= 1
            if kind in ("phone", "id_number") and q >= 0 and m[q][1][slice(*core_span(m[q][1]))].lower() in PLAIN_WORDS:
                continue
            (_, a, first), (_, b, last) = g[0], g[-1]
            s, e = a + core_span(first)[0], b + core_span(last)[1]
            if kind == "street_address" and _KEEP_DOT.match(text[b + core_span(last)[0] : e]) and text[e : e + 1] == ".":
                e += 1
            if kind == "email" and len(g) == 1 and (x := _EMAIL.search(text, s, e)):
                s, e = x.span()
            if e > s and _check(kind, text[s:e]):
                out.append((s, e, kind))

    @staticmethod
    def _street_word(m, g):
        """A number and a name that lack the kind of street take it from the next word."""
        word = lambda c: c[slice(*core_span(c))].lower()
        if not _DIGIT.search(g[0][2]) or any(word(c) in STREETS | STREETS_BEFORE for _, _, c in g[1:]) or g[-1][2][-1:] in ",;.":
            return g
        p = g[-1][0] + 1
        extra = [p] if p < len(m) and m[p][1].isspace() and m[p][1].count("\n") == 1 else []
        p += len(extra)
        return g + [(q, *m[q]) for q in (*extra, p)] if p < len(m) and word(m[p][1]) in STREETS else g

    def _parts(self, kind: str, g: list[tuple[int, int, str]]) -> list[list[tuple[int, int, str]]]:
        """Cut a span where an item of its kind must end, and trim formal words off names."""
        out: list[list] = [[]]
        number = street = False
        for i, (p, a, c) in enumerate(g):
            x, y = core_span(c)
            tail, w = c[y:], c[x:y]
            digits = bool(_DIGIT.search(w))
            if kind == "street_address" and digits:
                if number:
                    out.append([])
                    street = False
                number = True
            out[-1].append((p, a, c))
            last = i == len(g) - 1
            if kind == "street_address":
                street |= not digits and bool(w)
                ends = ";" in tail or (number and street and (digits or "," in tail)) or ("." in tail and not _KEEP_DOT.match(w))
            elif kind == "person_name":
                ends = ";" in tail or ("." in tail and len(w) > 1)
            else:
                ends = bool(set(tail) & set(";,.!?"))
            if ends and not last:
                out.append([])
                number = street = False
        blank = lambda q: q[2].isspace()
        formal = lambda q: (w := q[2][slice(*core_span(q[2]))].lower()) and (w in FORMAL or w in self.forms.ordinary) and w not in self.forms.given and w not in self.forms.surnames and len(w) > 1
        done = []
        for part in out:
            while part and (blank(part[-1]) or kind == "person_name" and formal(part[-1])):
                part.pop()
            while part and (blank(part[0]) or kind == "person_name" and formal(part[0])):
                part.pop(0)
            if part and not (kind == "person_name" and any(map(formal, part))):
                done.append(part)
        return done


_LETTERS = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"[^\S\n]*[\r\n]+\s*")


def _plain_words(text: str, given: set[str]) -> set[str]:
    """Words of a text in small letters or away from given names."""
    raw = _LETTERS.findall(text)
    ws = [w.lower() for w in raw]
    alone = {w for p, w, n in zip(["", *ws], ws, [*ws[1:], ""]) if p not in given and n not in given and len(p) != 1}
    return {w for w in alone | {w for w in raw if w.islower()} if len(w) > 1}


def ordinary_words(turns: DataFrame, given: set[str], surnames: set[str]) -> set[str]:
    """Words that stand in small letters or away from given names in ``ORDINARY`` texts and ``ORDINARY_SHARE`` of all, and are no known name."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = Counter(w for t in b.column("text").to_pylist() for w in _plain_words(t, given))
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["w", "n"])

    texts = turns.select(F.col("text").cast("string").alias("text")).where("text is not null")
    least = max(ORDINARY, math.ceil(ORDINARY_SHARE * texts.count()))
    often = texts.mapInArrow(count, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("w")
    return {r[0] for r in collect_bounded(often, 1_000_000)} - surnames - given


def _finder(turns: DataFrame, contacts: DataFrame, subjects: DataFrame):
    """A broadcast (tagger, given names, surnames, ordinary words); name tables are fixed and bounded, the words are counted over all texts."""
    spark = turns.sparkSession
    names = collect_bounded(contacts.select("given_name", "surname"), 100_000)
    given = {r[0].strip().lower() for r in names if r[0] and r[0].strip()}
    sur = {r[1].strip().lower() for r in names if r[1] and r[1].strip()}
    for r in collect_bounded(subjects.select("display_name"), 100_000):
        p = (r[0] or "").split()
        if len(p) > 1:
            given.add(p[0].lower())
            sur.add(p[-1].lower())
    return spark.sparkContext.broadcast((Tagger(), given, sur, ordinary_words(turns, given, sur)))


def _run(turns: DataFrame, contacts: DataFrame, subjects: DataFrame, emit, schema: str) -> DataFrame:
    sent = _finder(turns, contacts, subjects)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(*sent.value)
        names = [x.split()[0] for x in schema.split(", ")]
        for b in batches:
            ids, texts = b.column("turn_id").to_pylist(), b.column("text").to_pylist()
            for s in range(0, len(ids), 4000):
                rows = emit(ids[s : s + 4000], texts[s : s + 4000], find(texts[s : s + 4000]))
                if rows:
                    kinds = [pa.int64() if " bigint" in x else pa.string() for x in schema.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return turns.select(F.col("turn_id").cast("bigint").alias("turn_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def personal_items(turns: DataFrame, contacts: DataFrame, subjects: DataFrame) -> DataFrame:
    """Each distinct item ``(turn_id, kind, found)`` of every turn; a line break in an item is one blank.

    A conditional random field over word shapes labels every word
    of every text; spans that cannot be of their kind (an address without at sign, a
    phone number of five digits) are left out.  Null, empty and plain texts give no
    rows.  Two turns with one id are two texts.
    """

    def emit(ids, texts, found):
        return [x for d, t, f in zip(ids, texts, found) for x in dict.fromkeys((d, k, _BREAK.sub(" ", t[a:b])) for a, b, k in f)]

    return _run(turns, contacts, subjects, emit, "turn_id bigint, kind string, found string")


def redacted(turns: DataFrame, contacts: DataFrame, subjects: DataFrame) -> DataFrame:
    """``(turn_id, n_items, text)`` of every turn, items replaced by placeholders such as ``[EMAIL]``, the rest unchanged; null stays null."""

    def emit(ids, texts, found):
        rows = []
        for d, t, f in zip(ids, texts, found):
            pos, parts = 0, []
            for a, b, k in sorted(f):
                parts += [t[pos:a], PLACEHOLDER[k]]
                pos = b
            rows.append((d, len(f), None if t is None else "".join(parts) + t[pos:]))
        return rows

    return _run(turns, contacts, subjects, emit, "turn_id bigint, n_items bigint, text string")
