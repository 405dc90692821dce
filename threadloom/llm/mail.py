"""Problem 6: mail bodies reduced to what the sender newly wrote, by a sequence model over lines."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.crf import CRF

#: new; introducing or header line of a quotation; line with quote mark; quoted line without mark; signature; disclaimer.
LABELS = ("new", "head", "marked", "block", "signature", "notice")
TRAIN_MAILS = 1200

# Words of mail formats in English, German, French, Spanish, Italian, Portuguese and Dutch.
WROTE = ["wrote", "schrieb", "a écrit", "escribió", "schreef", "ha scritto", "escreveu"]
OPENERS = ["On", "Am", "Le", "El", "Op", "Il", "Em"]
FIELDS = ["From", "Sent", "Date", "To", "Cc", "Subject", "Reply-To", "Von", "Gesendet", "Datum", "An", "Betreff", "De", "Envoyé", "Objet", "À", "Enviado", "Fecha", "Para", "Asunto", "Da", "Inviato", "A", "Oggetto", "Data", "Assunto", "Van", "Verzonden", "Aan", "Onderwerp"]
BANNERS = ["Original Message", "Forwarded message", "Begin forwarded message", "Ursprüngliche Nachricht", "Weitergeleitete Nachricht", "Message d'origine", "Message transféré", "Mensaje original", "Mensaje reenviado", "Messaggio originale", "Messaggio inoltrato", "Mensagem original", "Mensagem encaminhada", "Oorspronkelijk bericht", "Doorgestuurd bericht"]
CLOSINGS = ["best", "best regards", "best wishes", "kind regards", "warm regards", "regards", "cheers", "thanks", "many thanks", "thank you", "thx", "yours", "yours sincerely", "yours faithfully", "sincerely", "all the best", "talk soon", "take care", "viele grüße", "beste grüße", "liebe grüße", "mit freundlichen grüßen", "mfg", "gruß", "danke", "cordialement", "bien à vous", "amicalement", "merci", "à bientôt", "saludos", "un saludo", "atentamente", "gracias", "cordiali saluti", "saluti", "grazie", "a presto", "atenciosamente", "cumprimentos", "abraços", "obrigado", "obrigada", "groeten", "met vriendelijke groet", "vriendelijke groeten", "bedankt"]
PROGRAM = ["Sent from my phone", "Sent from my tablet", "Sent from a mobile device", "Get the app for tablets", "Sent with a mail program", "Von unterwegs gesendet", "Von meinem Telefon gesendet", "Envoyé de mon téléphone", "Envoyé depuis mon mobile", "Enviado desde mi móvil", "Inviato dal mio telefono", "Enviado do meu telemóvel", "Verzonden vanaf mijn telefoon"]
NOTICES = [
    "This message and any attachment are confidential and intended only for the person named above.",
    "CONFIDENTIALITY NOTICE: this transmission contains information protected by law.",
    "The contents of this e-mail may be privileged and meant solely for the addressee.",
    "If you received it in error, please delete it and tell the sender.",
    "Unauthorised copying is prohibited.",
    "No liability is accepted for viruses.",
    "Please consider the environment before printing.",
    "Diese Nachricht ist vertraulich und nur für den Empfänger bestimmt.",
    "Ce message est confidentiel et réservé à son destinataire.",
    "Este mensaje es confidencial y está destinado solo a su destinatario.",
    "Questo messaggio è riservato e destinato solo al destinatario indicato.",
    "Esta mensagem é confidencial e destina-se apenas ao destinatário.",
    "Dit bericht is vertrouwelijk en alleen bestemd voor de geadresseerde.",
]
GREETINGS = ["Hi", "Hello", "Hey", "Dear", "Good morning", "Hallo", "Liebe", "Lieber", "Bonjour", "Hola", "Ciao", "Olá", "Beste"]
NOTICE_WORDS = ["confidential", "confidentiality", "privileged", "vertraulich", "confidentiel", "confidencial", "riservato", "vertrouwelijk", "attachment", "transmission", "liability", "viruses", "printing", "environment", "addressee", "unauthorised", "prohibited", "destinataire", "destinatario", "destinatário", "empfänger", "geadresseerde", "intended", "solely", "received", "error", "protected", "law", "delete", "réservé", "bestimmt", "notice"]
PLACES = ["Accounts", "Sales", "Support", "Office Manager", "Head of Design", "Desk 12", "Room 4", "Studio and Shop", "Workshop", "Legal", "Engineering Team", "Field Office"]

QUOTE = re.compile(r"^\s*[>|]")
BANNER = re.compile(r"(?i)^\W*(?:" + "|".join(map(re.escape, BANNERS)) + r")\W*$")
FIELD = re.compile(r"^\s*[*_]?(?:" + "|".join(FIELDS) + r")[*_]?\s?:", re.I)
RULE = re.compile(r"^\s*(?:--+|__+|==+|~~+|\*\*+|—+)\s*$")
WROTE_END = re.compile(r"(?i)(?:" + "|".join(WROTE) + r")\s*:\s*$|\b(?:schrieb|schreef)\b.*:\s*$")
OPEN = re.compile(r"^(?:" + "|".join(OPENERS) + r")\b")
DATE = re.compile(r"\d{1,4}[./-]\d{1,2}[./-]\d{2,4}|\d{1,2}:\d{2}")
MAILADDR = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+")
PHONE = re.compile(r"^\W*(?:[A-Za-z.]{1,7}:?\s*)?[+(]?\d[\d\s().\-/‐-―  ]{5,}$")
NAME = re.compile(r"^[^\W\d_][^\W\d_'.-]*\.?(?:\s+[^\W\d_][^\W\d_'.-]*){0,3}$")
GREET = re.compile(r"(?i)^(?:" + "|".join(GREETINGS) + r")\b[^.?]{0,40}$")
ROBOT = re.compile(r"(?i)^(?:" + "|".join(re.escape(" ".join(p.split()[:2])) for p in PROGRAM) + r")\b")
_CLOSE = set(CLOSINGS)
_NOTICE = set(NOTICE_WORDS)
_NOTICE_OPENS = tuple(" ".join(x.lower().split()[:3]) for x in NOTICES)
_WORDS = re.compile(r"[^\W\d_]+")


def _shape(line: str) -> tuple[str, ...]:
    """What a line looks like by itself."""
    s = line.strip()
    out = []
    if QUOTE.match(line):
        return ("quote",)
    low = s.lower().rstrip(" ,.!;-–")
    ws = _WORDS.findall(s)
    if RULE.match(s):
        out.append("rule")
    if BANNER.match(s):
        out.append("banner")
    if FIELD.match(s):
        out.append("field")
    if WROTE_END.search(s):
        out.append("wrote")
        if len(ws) <= 2:
            out.append("wrote-alone")
    if s.endswith(":"):
        out.append("colon")
    if OPEN.match(s):
        out.append("opens")
    if DATE.search(s):
        out.append("date")
    if MAILADDR.search(s):
        out.append("address")
        if MAILADDR.fullmatch(s.strip("<>")):
            out.append("only-address")
        if s.rstrip(":").endswith(">"):
            out.append("address-end")
    if low in _CLOSE:
        out.append("closing")
    if ROBOT.match(s):
        out.append("robot")
    if PHONE.match(s):
        out.append("phone")
    if GREET.match(s):
        out.append("greets")
    if any(s.lower().startswith(x) for x in _NOTICE_OPENS):
        out.append("notice-opens")
    n = sum(w.lower() in _NOTICE for w in ws)
    if n:
        out.append(f"legal{min(n, 3)}")
    if NAME.match(s) and all(w[0].isupper() for w in ws):
        out.append(f"name{min(len(ws), 4)}")
    out.append("w" + ("0" if not ws else "1" if len(ws) == 1 else "2" if len(ws) == 2 else "4" if len(ws) < 5 else "9" if len(ws) < 10 else "L"))
    if s[-1:] in ".!?":
        out.append("stop")
    if s[:1].islower():
        out.append("lower")
    if s[:1] in "-*•":
        out.append("bullet")
    return tuple(out)


def line_features(text: str, cache: dict[str, tuple[str, ...]] | None = None) -> tuple[list[int], list[tuple[str, ...]]]:
    """Numbers (from 1) and features of the lines that are not blank: own shape, neighbours, paragraph, position."""
    raw = text.split("\n")
    keep = [i for i, x in enumerate(raw) if x.strip()]
    shapes = []
    for i in keep:
        x = raw[i]
        s = cache.get(x) if cache is not None else None
        if s is None:
            s = _shape(x)
            if cache is not None:
                if len(cache) > 50_000:
                    cache.clear()
                cache[x] = s
        shapes.append(s)
    n = len(keep)
    before = [i == 0 or keep[i] - keep[i - 1] > 1 for i in range(n)]
    para = np.cumsum(before) if n else []
    legal: dict[int, int] = {}
    for p, s in zip(para, shapes):
        legal[p] = legal.get(p, 0) + sum(int(f[5:]) for f in s if f.startswith("legal"))
    first_of: dict[int, tuple[str, ...]] = {}
    for p, s in zip(para, shapes):
        first_of.setdefault(p, s)
    out = []
    block = ruled = closed = False
    since = 9
    for i in range(n):
        s = shapes[i]
        prev = shapes[i - 1] if i else ("start",)
        nxt = shapes[i + 1] if i + 1 < n else ("end",)
        if s == ("quote",):
            # a quote mark says more than what stands around it
            out.append(("own:quote", "by-quote" if "quote" in prev or "quote" in nxt else "lone-quote"))
            since += 1
            continue
        f = ["own:" + x for x in s]
        f += ["prev:" + x for x in prev] + ["next:" + x for x in nxt]
        f += [a + "+" + b for a in s for b in prev if b in ("rule", "closing", "banner", "field", "wrote", "start", "quote", "address-end", "opens") and not a.startswith("w")]
        f += [a + "&" + b for a in s for b in nxt if b in ("quote", "wrote-alone", "field", "end", "rule", "wrote") and not a.startswith("w")]
        f.append(f"para-legal{min(legal[para[i]], 3)}")
        if "legal1" in first_of[para[i]] or "legal2" in first_of[para[i]] or "legal3" in first_of[para[i]]:
            f.append("para-opens-legal")
        if "notice-opens" in first_of[para[i]]:
            f.append("para-notice-opens")
        f.append("gap" if before[i] else "run")
        f.append(f"top{min(i, 3)}")
        f.append(f"tail{min(n - 1 - i, 5)}")
        if block:
            f.append("after-block")
        if ruled:
            f.append(f"after-rule{min(since, 5)}")
        if closed:
            f.append("after-closing")
        if "banner" in s or ("field" in s and ("field" in nxt or "field" in prev) and ("date" in s or "address" in s)):
            block = True
        if "rule" in s:
            ruled, since = True, 0
        else:
            since += 1
        if "closing" in s:
            closed = True
        out.append(tuple(f))
    return [i + 1 for i in keep], out


def training_mails(n: int = TRAIN_MAILS, seed: int = 7) -> list[tuple[str, list[str]]]:
    """A labelled table made by rule: mails with the label of every line that is not blank.

    Sentences are drawn from a small vocabulary, so only form can be learnt.
    """
    r = random.Random(seed)
    first = ["Ada", "Bela", "Cyril", "Doro", "Edda", "Falk", "Gesa", "Hanno", "Ivo", "Jutta"]
    last = ["Brenner", "Castell", "Dorval", "Ekholm", "Farina", "Garrido", "Hallam", "Ibarra"]
    nouns = "table report garden meeting plan ticket window draft server letter budget train sample house poem lens".split()
    adjs = "new old small cold quiet open late early dry local".split()
    verbs = "moved checked wrote sent found closed opened forwarded kept dropped printed read".split()
    subj = "I We They Somebody She Our team The neighbour Nobody".split(" ")

    def sentence() -> str:
        k = r.random()
        a = f"the {r.choice(adjs)} {r.choice(nouns)}"
        if k < 0.1:
            return f"Can you {r.choice(['move', 'check', 'send', 'open'])} {a} and the {r.choice(nouns)} {r.choice(nouns)}?"
        if k < 0.14:
            return f"On the phone the {r.choice(nouns)} vendor wrote: {a} is gone."
        if k < 0.17:
            return f"From: here on {a} is open, sent on {r.randint(1, 28)}.{r.randint(1, 12)}.2024."
        if k < 0.2:
            return f"Write to {r.choice(first).lower()}@mail.example about {a}."
        if k < 0.23:
            return f"This is {r.choice(['confidential nonsense', 'an error in the law', 'the attachment'])}, please delete it."
        if k < 0.26:
            return f"Thanks for {a}, the regards of {r.choice(first)} came early."
        return f"{r.choice(subj)} {r.choice(verbs)} {a} {r.choice(['before', 'near', 'after', 'without'])} the {r.choice(nouns)} {r.choice(['today', 'again', 'slowly', 'twice'])}{r.choice('..!')}"

    def wrap(text: str, width: int) -> list[str]:
        out, cur = [], ""
        for w in text.split():
            if cur and len(cur) + 1 + len(w) > width:
                out.append(cur)
                cur = w
            else:
                cur = f"{cur} {w}".strip()
        return [*out, cur]

    def para(lo: int = 1, hi: int = 5, width: int = 0) -> list[str]:
        t = " ".join(sentence() for _ in range(r.randint(lo, hi)))
        return wrap(t, width) if width else [t]

    def person() -> tuple[str, str]:
        a, b = r.choice(first), r.choice(last)
        return f"{a} {b}", f"{a.lower()}.{b.lower()}{r.choice(['', '7', '+x'])}@{r.choice(['mail.example', 'post.example', 'studio.example.org'])}"

    def when() -> str:
        d, m, y, h = r.randint(1, 28), r.randint(1, 12), r.randint(2019, 2026), f"{r.randint(0, 23):02}:{r.randint(0, 59):02}"
        return r.choice([f"{d:02}.{m:02}.{y} um {h}", f"{d:02}/{m:02}/{y} {h}", f"Mon, {d:02} Mar {y} at {h}", f"Mar {d:02}, {y}, at {h} PM", f"{y}-{m:02}-{d:02} {h}", f"{d:02}.{m:02}.{y} {h}"])

    def head() -> list[str]:
        who, addr = person()
        k = r.random()
        if k < 0.12:
            return [f"{who} wrote:"] if r.random() < 0.6 else [who, "wrote:"]
        i = r.randrange(7)
        by = f"{who} <{addr}>" if r.random() < 0.85 else r.choice([who, f"<{addr}>"])
        text = f"{OPENERS[i]} {when()}{',' if i not in (1, 5) else ''} {WROTE[i] + ' ' + by if i in (1, 4) else by + ' ' + WROTE[i]}{' ' if i == 2 else ''}:"
        if r.random() < 0.2 and not text.endswith(">:"):
            at = text.rindex(by) + len(by)
            if text[at:].strip() != ":":
                return [text[:at], text[at:].strip()]
        return [text]

    def quoted(width: int) -> list[str]:
        mark = r.choice(["> ", ">", "| ", "  > ", "> "])
        body = []
        for _ in range(r.randint(1, 2)):
            body += para(1, 3, width) + ([""] if r.random() < 0.3 else [])
        if r.random() < 0.3:
            body += [mark + x for x in [r.choice(GREETINGS) + " " + r.choice(first) + ","] * (r.random() < 0.5) + para(1, 2, width)]
        return [(mark + x).rstrip() if x or mark.strip() else mark for x in body]

    mails = []
    for _ in range(n):
        lines: list[tuple[str, str]] = []
        width = r.choice([0, 0, 60, 66, 72])
        add = lambda ls, lab: lines.extend((x, lab) for x in ls)
        gap = lambda p=0.8: lines.append(("", "")) if r.random() < p else None
        me, mine = person()
        if r.random() < 0.1:
            add([sentence() for _ in range(r.randint(1, 2))], "new")
        if r.random() < 0.65:
            add([f"{r.choice(GREETINGS)} {r.choice(first)}{r.choice([',', '!', ' -', '', ':'])}"], "new")
            gap()
        inline = r.random() < 0.25
        if inline:
            if r.random() < 0.5:
                add(head(), "head")
            else:
                add(para(1, 2, width), "new")
                gap(0.9)
            for _ in range(r.randint(1, 3)):
                add(quoted(width or 70) if r.random() < 0.7 else ["> " + " ".join(sentence().split()[: r.randint(2, 7)])], "marked")
                gap(0.8)
                add(para(1, 4, width) if r.random() < 0.7 else [" ".join(sentence().split()[: r.randint(1, 5)])], "new")
                gap(0.9)
        else:
            for _ in range(r.randint(1, 3)):
                add(para(1, 5, width), "new")
                if r.random() < 0.12:
                    add([f"- the {r.choice(nouns)} {r.choice(nouns)} {r.choice(['finally', 'again'])}" for _ in range(3)], "new")
                if r.random() < 0.06:
                    add(["", r.choice(["See below.", "As discussed", "Yes", "No idea", "tomorrow."])], "new")
                gap(0.95)
        if r.random() < 0.4:
            c = r.choice(CLOSINGS)
            add([(c.capitalize() if r.random() < 0.9 else c) + r.choice([",", "", "!", ","])], "signature")
            if r.random() < 0.85:
                add([r.choice([me, me.split()[0], me.split()[0][0] + "."])], "signature")
            gap(0.5)
        if r.random() < 0.55:
            add([r.choice(["--", "-- ", "____________", "________________________________", "==="])], "signature")
            add([me], "signature")
            for x in (r.choice(PLACES), r.choice(["T: ", "Tel. ", "m ", ""]) + r.choice(["+1 212 555 0147", "020 7946 0101", "(416) 555-0107", "030/23125-159", "07700 900252", "950-555-0144"]), mine):
                if r.random() < 0.6:
                    add([x], "signature")
            gap()
        if r.random() < 0.3:
            add([r.choice(PROGRAM)], "signature")
            gap()
        tail = []
        if r.random() < 0.45:
            t = " ".join(r.sample(NOTICES, r.choice([1, 1, 2, 3])))
            tail.append([(x, "notice") for x in (wrap(t, width or r.choice([60, 70])) if r.random() < 0.7 else [t])])
        k = r.random()
        if not inline and k < 0.45:
            tail.append([(x, "head") for x in head()] + [(x, "marked") for x in quoted(width or 66)])
        elif k < 0.7 and not inline:
            b = r.choice(BANNERS)
            deco = r.choice(["-----{}-----", "---------- {} ----------", "{}:", "----- {} -----"])
            star = r.choice(["", "*"])
            who, addr = person()
            rows = [r.choice(["", "________________________________"])] if r.random() < 0.2 else []
            rows += [deco.format(b)] if r.random() < 0.9 else []
            pick = r.choice([("From", "Sent", "To", "Subject"), ("From", "Date", "Subject"), ("Von", "Gesendet", "An", "Betreff"), ("De", "Date", "Objet"), ("De", "Enviado", "Para", "Asunto"), ("Van", "Verzonden", "Aan", "Onderwerp")])
            vals = {0: f"{who} <{addr}>", 1: when()}
            rows += [f"{star}{x}:{star} {vals.get(j, who if j == 2 and len(pick) == 4 else 'the ' + r.choice(nouns))}" for j, x in enumerate(pick)]
            part = [(x, "head" if x else "") for x in rows] + [("", "")]
            for _ in range(r.randint(1, 3)):
                if r.random() < 0.3:
                    part.append((f"{r.choice(GREETINGS)} {r.choice(first)},", "block"))
                part += [(x, "block") for x in para(1, 4, width or 64)] + [("", "")]
            if r.random() < 0.25:
                part += [(r.choice(CLOSINGS).capitalize(), "block"), (who, "block")]
            tail.append(part)
        if len(tail) == 2 and r.random() < 0.5:
            tail.reverse()
        for part in tail:
            lines += part
            gap()
        if r.random() < 0.1:
            lines = [(x + "\r", lab) for x, lab in lines]
        text = "\n".join(x for x, _ in lines)
        mails.append((text, [lab for x, lab in lines if x.strip()]))
    return mails


def fit(n: int = TRAIN_MAILS) -> CRF:
    table = training_mails(n)
    return CRF(LABELS).fit([line_features(t)[1] for t, _ in table], [g for _, g in table], rounds=200, parts=3)


def label_lines(mails: DataFrame, model: CRF | None = None) -> DataFrame:
    """``(turn_id, line_no, label, line)`` of every line that is not blank, counted from 1 at each newline character."""
    sent = mails.sparkSession.sparkContext.broadcast(model or fit())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf, cache = sent.value, {}
        known: dict[tuple[str, ...], int] = {}
        table: list[np.ndarray] = []
        names = np.array(crf.labels)
        for b in batches:
            ids, nos, lines, rows, lens = [], [], [], [], []
            for d, t in zip(b.column("turn_id").to_pylist(), b.column("text").to_pylist()):
                no, feats = line_features(t, cache)
                raw = t.split("\n")
                for f in feats:
                    at = known.get(f)
                    if at is None:
                        if len(table) > 200_000:
                            table = [table[i] for i in rows]
                            known, rows = {}, list(range(len(rows)))
                        at = known[f] = len(table)
                        table.append(crf.row(f))
                    rows.append(at)
                ids += [d] * len(no)
                nos += no
                lines += [raw[i - 1] for i in no]
                lens.append(len(no))
            if not ids:
                continue
            got = crf.viterbi(np.stack(table)[np.array(rows)], np.array(lens))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nos, pa.int32()), pa.array(names[got]), pa.array(lines)], names=["turn_id", "line_no", "label", "line"])

    m = mails.select(F.col("turn_id").cast("bigint").alias("turn_id"), F.col("text").cast("string").alias("text")).where(r"text rlike '(?U)\\S'")
    return m.mapInArrow(run, "turn_id bigint, line_no int, label string, line string")


def mail_turns(turns: DataFrame) -> DataFrame:
    return turns.where(F.lower(F.regexp_replace("source", r"(?U)^\s+|\s+$", "")) == "mail")


def foreign_lines(turns: DataFrame) -> DataFrame:
    """``(turn_id, line_no)`` of the lines of mail turns that the sender did not newly write.

    Null, empty and blank mails give no rows; other sources take no part.
    """
    return label_lines(mail_turns(turns)).where("label <> 'new'").select("turn_id", "line_no")


def new_text(turns: DataFrame) -> DataFrame:
    """``(turn_id, new_text, n_lines, n_new)`` of every mail turn: the newly written lines, blank lines between them kept once.

    A mail without text, or with nothing new, has an empty ``new_text``.
    """
    m = mail_turns(turns).select(F.col("turn_id").cast("bigint").alias("turn_id"))
    lab = label_lines(mail_turns(turns))
    kept = lab.groupBy("turn_id").agg(
        F.count("*").alias("n_lines"),
        F.array_sort(F.collect_list(F.when(F.col("label") == "new", F.struct("line_no", "line")))).alias("l"),
    )
    text = F.aggregate(
        "l",
        F.struct(F.lit("").alias("t"), F.lit(0).alias("no")),
        lambda a, x: F.struct(F.concat(a["t"], F.when(a["no"] == 0, "").when(x["line_no"] - a["no"] > 1, "\n\n").otherwise("\n"), F.regexp_replace(x["line"], r"\s+$", "")).alias("t"), x["line_no"].alias("no")),
        lambda a: a["t"],
    )
    kept = kept.select("turn_id", text.alias("new_text"), "n_lines", F.size("l").cast("bigint").alias("n_new"))
    return m.join(kept, "turn_id", "left").na.fill({"new_text": "", "n_lines": 0, "n_new": 0})
