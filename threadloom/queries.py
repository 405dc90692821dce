"""Queries of the reference's operators over the test tables, each with SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.functions import scrub, text
from threadloom.operators import evaluation as ev
from threadloom.operators import provenance, style
from threadloom.operators import turns as ops
from threadloom.plans import corpus
from threadloom.session import collect_bounded, ship_package, table

Query = Callable[[SparkSession, str], DataFrame]

#: The instant all moving windows are measured from.
NOW = "2026-03-01 00:00:00"
KEY = b"an example key for tests, not a secret"
#: Entities for the absence queries: words of the test texts with a kind.
ENTITIES = {"bridge": "product", "garden": "feature", "server": "tech", "meeting": "org", "ledger": "service", "zzqx": "product"}
ROUND = 9


def split_now():
    return F.timestamp_micros(F.lit(MICROS))


MICROS = 1772323200000000  # NOW in microseconds

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a data directory by name, with the session they are read in."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(sql: str | None = None):
    def add(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(Tables(spark, sf_dir))

        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


SRC = "lower(trim(source))"
BUCKET = "(('0x' || substr(sha256(thread_id), 1, 8))::BIGINT % 100)"
SPLIT = f"CASE WHEN epoch_us(ts) > {MICROS} - 12::BIGINT * 7 * 86400 * 1000000 THEN 'quarantined' WHEN {BUCKET} < 15 THEN 'heldout' ELSE 'train' END"


# splits, replies, volume


@query(f"SELECT {SPLIT} AS split, count(*) AS n FROM turns GROUP BY 1")
def split_counts(t):
    return ops.split_counts(t("turns"), split_now())


@query(f"SELECT turn_id, {SPLIT} AS split, {BUCKET} AS bucket FROM turns")
def split_by_thread(t):
    return ops.split_corpus(t("turns"), split_now()).select("turn_id", "split", text.thread_bucket(F.col("thread_id")).alias("bucket"))


@query(f"SELECT turn_id, coalesce(epoch_us(ts) > {MICROS} - 12::BIGINT * 7 * 86400 * 1000000, false) AS quarantined FROM turns")
def quarantine_split(t):
    return t("turns").select("turn_id", F.coalesce(ops.is_quarantined(F.col("ts"), split_now()), F.lit(False)).alias("quarantined"))


def _unique_turns(t) -> DataFrame:
    """Messages read twice once, so that (ts, source_id) orders a thread; the smallest turn_id stays."""
    d = t("turns").withColumn("source", text.source_key(F.col("source")))
    one = d.groupBy("source", "source_id").agg(F.min("turn_id").alias("turn_id")).select("turn_id")
    return d.join(one, "turn_id", "left_semi")


UNIQUE = f"(SELECT * EXCLUDE (source), {SRC} AS source FROM turns QUALIFY row_number() OVER (PARTITION BY {SRC}, source_id ORDER BY turn_id) = 1)"
PAIRS = f"""
WITH u AS {UNIQUE},
c AS (SELECT *, list({{'ts': ts, 'sid': source_id, 'subj': is_subject, 'turn_id': turn_id}}) OVER (PARTITION BY thread_id ORDER BY ts, source_id, turn_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS before FROM u WHERE thread_id IS NOT NULL AND ts IS NOT NULL),
k AS (SELECT turn_id, thread_id, list_filter(before, lambda x: x.ts >= ts - INTERVAL 180 MINUTES) AS context FROM c WHERE coalesce(is_subject, false)),
p AS (SELECT turn_id, thread_id, context FROM k WHERE len(list_filter(context, lambda x: NOT coalesce(x.subj, false))) > 0)
"""


def _pairs(t) -> DataFrame:
    d = _unique_turns(t)
    return ops.reply_pairs(d.withColumn("source_id", F.struct("source_id", "turn_id")))


@query(PAIRS + "SELECT turn_id, thread_id, array_to_string(list_transform(context, lambda x: x.turn_id::VARCHAR), ',') AS context_ids FROM p")
def reply_pairs(t):
    ids = F.array_join(F.transform("context", lambda x: x["source_id"]["turn_id"].cast("string")), ",")
    return _pairs(t).select("turn_id", "thread_id", ids.alias("context_ids"))


@query(PAIRS + "SELECT len(context)::BIGINT AS context_length, count(*) AS n FROM p GROUP BY 1")
def context_length_hist(t):
    return _pairs(t).groupBy(F.size("context").cast("bigint").alias("context_length")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS total_turns, count(*) FILTER (is_subject) AS subject_turns, sum(length(text)) FILTER (is_subject)::BIGINT AS subject_chars, (sum(length(text)) FILTER (is_subject) // 4)::BIGINT AS approx_tokens, round((sum(length(text)) FILTER (is_subject) // 4) / 1e6 * 3.0, 6) AS cost FROM turns")
def volume_report(t):
    return ops.volume(t("turns"))


@query(f"SELECT {SRC} AS source, count(*) AS n FROM turns WHERE is_subject GROUP BY 1")
def turns_by_source(t):
    return ops.by_source(t("turns"))


@query("SELECT DISTINCT corpus_version FROM turns WHERE corpus_version IS NOT NULL")
def corpus_versions(t):
    return t("turns").where("corpus_version is not null").select("corpus_version").distinct()


@query("SELECT turn_id, row_number() OVER (ORDER BY ts, source_id, turn_id) AS pos FROM turns WHERE corpus_version = 'v3'")
def corpus_read_order(t):
    """The read order of a version; ranks within a day plus the days before, so no task sorts the whole version."""
    d = t("turns").where("corpus_version = 'v3'").withColumn("day", F.to_date("ts"))
    days = d.groupBy("day").count().withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    r = F.row_number().over(Window.partitionBy("day").orderBy("ts", "source_id", "turn_id"))
    return d.withColumn("r", r).join(F.broadcast(days), "day").select("turn_id", (F.col("before") + F.col("r")).alias("pos"))


# vault and envelopes


@query(f"SELECT subject_id, {SRC} AS source, source_id, count(*) AS n_copies, min(epoch_us(ingested_at)) AS first_ingested FROM envelopes GROUP BY 1, 2, 3")
def vault_dedupe(t):
    e = t("envelopes").withColumn("source", text.source_key(F.col("source")))
    n = e.groupBy("subject_id", "source", "source_id").agg(F.count("*").alias("n_copies"))
    one = ops.vault_dedupe(e).select("subject_id", "source", "source_id", F.unix_micros("ingested_at").alias("first_ingested"))
    return one.join(n, ["subject_id", "source", "source_id"])


@query(f"SELECT DISTINCT subject_id, {SRC} AS source, source_id FROM envelopes e WHERE epoch_us(ingested_at) >= {MICROS} AND NOT EXISTS (SELECT 1 FROM envelopes o WHERE o.subject_id = e.subject_id AND lower(trim(o.source)) = lower(trim(e.source)) AND o.source_id = e.source_id AND epoch_us(o.ingested_at) < {MICROS})")
def vault_incremental(t):
    e = t("envelopes").withColumn("source", text.source_key(F.col("source")))
    late = F.col("ingested_at") >= split_now()
    return ops.new_to_vault(e.where(late), e.where(~late)).select("subject_id", "source", "source_id")


@query("SELECT json_extract_string(CASE WHEN json_valid(payload) THEN payload END, '$.chat_guid') AS chat_guid, count(*) AS n FROM envelopes WHERE lower(trim(source)) = 'imessage' GROUP BY 1")
def payload_threads(t):
    e = t("envelopes").where(text.source_key(F.col("source")) == "imessage")
    p = F.from_json("payload", "map<string,string>", {"allowSingleQuotes": "false"})
    return e.groupBy(p["chat_guid"].alias("chat_guid")).agg(F.count("*").alias("n"))


_NORMAL = """
WITH d AS (SELECT subject_id, lower(trim(source)) AS source, source_id, CASE WHEN json_valid(payload) AND payload LIKE '{%' THEN payload END AS o FROM envelopes QUALIFY row_number() OVER (PARTITION BY subject_id, source, source_id ORDER BY ingested_at, ts, payload) = 1),
x AS (SELECT *, trim(o ->> '$.text', ' ' || chr(9) || chr(10) || chr(13) || chr(160)) AS text, CASE source WHEN 'imessage' THEN o ->> '$.chat_guid' WHEN 'claude_ai' THEN o ->> '$.conversation_uuid' ELSE o ->> '$.conversation_id' END AS k, source <> 'imessage' OR (o ->> '$.is_from_me') = 'true' AS mine FROM d)
SELECT source, source_id, CASE WHEN coalesce(trim(k), '') IN ('', 'unknown') THEN source || ':orphan:' || source_id ELSE k END AS thread_id, CASE WHEN mine THEN subject_id ELSE coalesce(o ->> '$.handle', 'unknown') END AS author_id, mine AS is_subject, text FROM x WHERE coalesce(text, '') <> ''
"""


@query(_NORMAL)
def normalized_turns(t):
    """Envelopes through the normalizer registry; damaged payloads have no text and are dropped."""
    return ops.normalize(ops.vault_dedupe(t("envelopes"))).select("source", "source_id", "thread_id", "author_id", "is_subject", "text")


@query(f"SELECT {SRC} AS source, count(*) AS n, count(*) FILTER (thread_id LIKE '%:orphan:%') AS n_orphans FROM turns GROUP BY 1")
def orphan_threads(t):
    return t("turns").groupBy(text.source_key(F.col("source")).alias("source")).agg(F.count("*").alias("n"), F.count_if(F.col("thread_id").contains(":orphan:")).alias("n_orphans"))


VERSION = "(SELECT lower(trim(source)) AS source, source_id, text FROM turns WHERE corpus_version = '{}' QUALIFY row_number() OVER (PARTITION BY lower(trim(source)), source_id ORDER BY turn_id) = 1)"


@query(f"SELECT count(*) FILTER (b.source_id IS NULL) AS dropped, count(*) FILTER (a.source_id IS NULL) AS added, count(*) FILTER (a.source_id IS NOT NULL AND b.source_id IS NOT NULL AND a.text IS DISTINCT FROM b.text) AS rewritten, count(*) FILTER (a.source_id IS NOT NULL AND b.source_id IS NOT NULL AND a.text IS NOT DISTINCT FROM b.text) AS kept FROM {VERSION.format('v3')} a FULL JOIN {VERSION.format('v4')} b ON a.source = b.source AND a.source_id = b.source_id")
def golden_diff(t):
    """From version 3 to version 4; a message read twice stands in a version once."""
    one = lambda v: t("turns").where(F.col("corpus_version") == v).withColumn("source", text.source_key(F.col("source"))).groupBy("source", "source_id").agg(F.min(F.struct("turn_id", "text"))["text"].alias("text"))
    return ops.golden_diff(one("v3"), one("v4"))


# scrubbing

# The markers' view in SQL: the only character of the tables that NFKC changes for them is the no-break space.
_VIEW = "regexp_replace(regexp_replace(nfc_normalize(replace({}, chr(160), ' ')), '\\p{{Cf}}', '', 'g'), '[\\p{{Pd}}\\x{{2212}}]', '-', 'g')"
_W = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}"
_S = r"[\s\x0B\x1c-\x1f\x{85}\p{Z}]"
_SEP = rf"[-. ]{_S}{{0,4}}"
_NOUN = r"(?:routing|aba|account|acct|a/c)\.?"
_NUMBER = rf"(?:{_S}+(?:(?:number|nbr|num|no)\.?(?:[^a-zA-Z]|$)|#)|#)"
_MARKERS = {
    "ssn": rf"\p{{Nd}}{{3}}{_SEP}\p{{Nd}}{{2}}{_SEP}\p{{Nd}}{{4}}",
    "ein": rf"\p{{Nd}}{{2}}{_SEP}\p{{Nd}}{{7}}",
    "nine_digits": r"\p{Nd}{9,}",
    "grouped": rf"\p{{Nd}}{{4}}{_SEP}\p{{Nd}}{{4}}{_SEP}\p{{Nd}}{{4}}",
    "routing_number": rf"(?i)(?:^|[^{_W}])(?:routing|aba)\.?{_NUMBER}",
    "account_number": rf"(?i)(?:^|[^{_W}])(?:account|acct|a/c)\.?{_NUMBER}",
    "noun_digits": rf"(?i)(?:^|[^{_W}]){_NOUN}{_S}*:?{_S}*\p{{Nd}}{{4,}}",
}
_ANY_MARKER = "(" + " OR ".join(f"regexp_matches(v, '{p}')" for p in _MARKERS.values()) + ")"
_KARBON = f"({SRC} = 'karbon' OR {SRC} LIKE 'karbon\\_%' ESCAPE '\\')"
# Secrets in SQL: the vendors' shapes, or a token of high entropy.
_TOKEN = r"[A-Za-z0-9+/=_\-]{24,}"
_ENTROPY = "-list_sum(list_transform(list_distinct(string_split(x, '')), lambda c: (length(x) - length(replace(x, c, ''))) / length(x) * log2((length(x) - length(replace(x, c, ''))) / length(x))))"
_SHAPES = "|".join(scrub.SECRETS.values())
_HAS_SECRET = f"(regexp_matches(text, '{_SHAPES}') OR len(list_filter(regexp_extract_all(text, '{_TOKEN}'), lambda x: {_ENTROPY} >= 3.9)) > 0)"
# Names of the subjects in SQL, longest first, as whole words in any case.
_NAMES = "(SELECT string_agg(regexp_escape(n), '|' ORDER BY length(n) DESC, n) FROM (SELECT DISTINCT trim(n) AS n FROM (SELECT display_name AS n FROM subjects UNION ALL SELECT unnest(aliases) FROM subjects)) WHERE length(n) >= 3)"
_NAMED = f"regexp_matches(text, '(?i)(?:^|[^{_W}])(?:' || {_NAMES} || ')(?:$|[^{_W}])')"


@query(f"WITH d AS (SELECT {SRC} AS source, {_KARBON} AS named, {_VIEW.format('text')} AS v FROM turns WHERE text IS NOT NULL) SELECT source, CASE WHEN named OR {_ANY_MARKER} THEN 'confidential' ELSE 'open' END AS tier, count(*) AS n FROM d GROUP BY 1, 2")
def classify_turns(t):
    d = scrub.classify(t("turns").where("text is not null"))
    return d.groupBy(text.source_key(F.col("source")).alias("source"), "tier").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id FROM (SELECT doc_id, {_VIEW.format('text')} AS v FROM documents WHERE text IS NOT NULL) WHERE {_ANY_MARKER}")
def marked_documents(t):
    """Documents that hold any of the markers."""
    v = scrub.matching_view(t("documents").where("text is not null").select("doc_id", "text"))
    return v.where(scrub.marked(F.col("view"))).select("doc_id")


@query(f"WITH d AS (SELECT {_VIEW.format('text')} AS v FROM turns WHERE text IS NOT NULL) " + " UNION ALL ".join(f"SELECT '{n}' AS marker, count(*) AS n FROM d WHERE regexp_matches(v, '{p}') HAVING count(*) > 0" for n, p in _MARKERS.items()))
def marker_counts(t):
    """Turns per marker, each counted over all of them."""
    v = scrub.matching_view(t("turns").where("text is not null").select("turn_id", "text"))
    hits = F.array_compact(F.array(*[F.when(F.col("view").rlike(p), F.lit(n)) for n, p in scrub.MARKERS.items()]))
    return v.select("turn_id", F.explode(hits).alias("marker")).groupBy("marker").agg(F.count("*").alias("n"))


_FENCE = "regexp_replace(text, '(?s)```.*?```', '', 'g')"
_TRIMMED = f"regexp_replace(regexp_replace({_FENCE}, '^[\\s\\x0B\\x{{0085}}\\x{{00A0}}]+', ''), '[\\s\\x0B\\x{{0085}}\\x{{00A0}}]+$', '')"


@query(f"SELECT turn_id, length({_TRIMMED}) > 8000 OR length(text) - length({_TRIMMED}) > length(text) / 2.0 AS pasted FROM turns WHERE text IS NOT NULL")
def looks_pasted(t):
    d = t("turns").where("text is not null")
    return d.select("turn_id", text.looks_pasted(F.col("text"), text.strip_fences(F.col("text"))).alias("pasted"))


def _secret_tokens(d: DataFrame, id_: str) -> DataFrame:
    tok = d.select(id_, F.explode(F.regexp_extract_all("text", F.lit(f"({scrub.CANDIDATE})"), 1)).alias("token"))
    return tok.withColumn("entropy", F.round(scrub.entropy_of(F.col("token")), 6))


@query("WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9+/=_\\-]{24,}')) AS token FROM documents), c AS (SELECT doc_id, token, row_number() OVER () AS i FROM t), x AS (SELECT i, any_value(doc_id) AS doc_id, any_value(length(token)) AS n, ch, count(*) AS k FROM (SELECT i, doc_id, token, unnest(string_split(token, '')) AS ch FROM c) GROUP BY i, ch), e AS (SELECT i, any_value(doc_id) AS doc_id, round(-sum(k::DOUBLE / n * log2(k::DOUBLE / n)), 6) AS entropy FROM x GROUP BY i) SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (entropy >= 3.5) AS n_low, count(*) FILTER (entropy >= 3.9) AS n_high FROM e GROUP BY doc_id")
def secret_tokens(t):
    s = _secret_tokens(t("documents"), "doc_id")
    return s.groupBy("doc_id").agg(F.count("*").alias("n_tokens"), F.count_if(F.col("entropy") >= 3.5).alias("n_low"), F.count_if(F.col("entropy") >= 3.9).alias("n_high"))


_PIECES = f"list_zip(regexp_split_to_array(text, '{_TOKEN}'), list_transform(regexp_extract_all(text, '{_TOKEN}'), lambda x: CASE WHEN {_ENTROPY} >= 3.5 THEN '[REDACTED]' ELSE x END))"


@query(f"SELECT doc_id, redacted FROM (SELECT doc_id, text, array_to_string(list_transform({_PIECES}, lambda p: coalesce(p[1], '') || coalesce(p[2], '')), '') AS redacted FROM documents WHERE text IS NOT NULL) WHERE redacted <> text")
def redact_documents(t):
    """Documents with secrets replaced, at the lower entropy bound; only changed ones come out."""
    d = scrub.redact(t("documents").where("text is not null").select("doc_id", "text"), threshold=3.5)
    return d.where("redacted <> text").select("doc_id", "redacted")


def needles(t) -> list[str]:
    out = []
    for r in collect_bounded(t("subjects"), 10_000):
        out += [r["display_name"], *(r["aliases"] or [])]
    return [x for x in out if x]


def scrub_sql(x: str) -> str:
    return rf"regexp_replace({x}, '(?i)(^|[^{_W}])(?:' || {_NAMES} || ')($|[^{_W}])', '\1The Author\2', 'g')"


@query(f"SELECT turn_id, {scrub_sql(scrub_sql('text'))} AS scrubbed FROM turns WHERE {_NAMED}")
def identity_scrub(t):
    """Turns that name a subject, with the name replaced."""
    d = t("turns").where("text is not null").select("turn_id", "text")
    n = needles(t)
    d = d.where(F.col("text").rlike(scrub.identity_pattern(n)))
    return d.select("turn_id", scrub.scrub_identity(F.col("text"), n, "The Author").alias("scrubbed"))


def _blob(x: int) -> str:
    """The key block of the keyed hash as a literal."""
    return "'" + "".join(f"\\x{b ^ x:02X}" for b in KEY.ljust(64, b"\0")) + "'::BLOB"


@query(f"SELECT DISTINCT author_id, is_subject, CASE WHEN is_subject THEN author_id ELSE 'P-' || substr(sha256({_blob(0x5C)} || unhex(sha256({_blob(0x36)} || encode(author_id)))), 1, 12) END AS author_out FROM turns WHERE author_id IS NOT NULL")
def pseudonymize(t):
    d = t("turns").where("author_id is not null").select("author_id", "is_subject").distinct()
    return scrub.pseudonymize(d, KEY).select("author_id", "is_subject", "author_out")


_BUILD = (
    _NORMAL.replace("SELECT source, source_id, CASE", "SELECT source, source_id, coalesce(lower(o ->> '$.looks_pasted') = 'true', false) AS pasted, CASE").strip().replace("\nSELECT", ",\nn AS (SELECT", 1)
    + f"), k AS (SELECT pasted, {_KARBON} OR {_ANY_MARKER} AS confidential, {_HAS_SECRET} AS secret, {_NAMED} AS named FROM (SELECT *, {_VIEW.format('text')} AS v FROM n))"
)


@query(_BUILD + " SELECT count(*) FILTER (NOT confidential AND NOT pasted) AS written, count(*) FILTER (NOT confidential AND NOT pasted AND secret) AS redacted, count(*) FILTER (confidential) AS excluded_confidential, count(*) FILTER (NOT confidential AND pasted) AS excluded_pasted, count(*) FILTER (NOT confidential AND NOT pasted AND named) AS identity_scrubbed FROM k")
def build_report(t):
    d = corpus.dispositions(ops.vault_dedupe(t("envelopes")), needles(t), "The Author", KEY)
    return corpus.build_report(d)


_AUDIT = f"""
WITH d AS (SELECT *, {_VIEW.format('text')} AS v FROM turns WHERE text IS NOT NULL),
f AS (SELECT 'secret' AS finding, {SRC} || ':' || source_id AS place FROM d WHERE {_HAS_SECRET}
  UNION ALL SELECT 'confidential', {SRC} || ':' || source_id FROM d WHERE {_KARBON} OR {_ANY_MARKER}
  UNION ALL SELECT 'raw_author', {SRC} || ':' || source_id || ' author=' || CASE WHEN length(author_id) <= 4 THEN repeat('*', length(author_id)) ELSE substr(author_id, 1, 4) || '…(' || length(author_id) || ' chars)' END FROM (SELECT * REPLACE (coalesce(author_id, '') AS author_id) FROM d) WHERE NOT coalesce(is_subject, false) AND NOT regexp_full_match(author_id, 'P-[0-9a-f]{{12}}')
  UNION ALL SELECT 'name', {SRC} || ':' || source_id FROM d WHERE {_NAMED})
SELECT finding, count(*) AS n, array_to_string(list_sort(list_distinct(list(place)))[1:5], '; ') AS examples FROM f GROUP BY 1
"""


@query(_AUDIT)
def corpus_audit(t):
    return corpus.audit(t("turns").where("text is not null"), needles(t)).withColumn("examples", F.array_join("examples", "; "))


@query("SELECT turn_id, lower(regexp_extract(thread_id, '([^<>\\s]+@[^<>\\s]+)', 1)) AS address FROM turns WHERE lower(trim(source)) = 'mail'")
def mail_addresses(t):
    d = t("turns").where(text.source_key(F.col("source")) == "mail")
    return d.select("turn_id", F.lower(F.regexp_extract("thread_id", r"([^<>\s]+@[^<>\s]+)", 1)).alias("address"))


@query(r"""
WITH m AS (SELECT turn_id, regexp_replace(regexp_replace(text, '(?ms)^On [^\n]*wrote:\s*$.*', ''), '(?ms)^--\s*$.*', '') AS b FROM turns WHERE lower(trim(source)) = 'mail' AND text IS NOT NULL)
SELECT turn_id, regexp_replace(regexp_replace(array_to_string(list_filter(string_split(b, chr(10)), lambda x: NOT starts_with(ltrim(x, ' '), '>')), chr(10)), '^[\s\x0B\x{0085}\x{00A0}]+', ''), '[\s\x0B\x{0085}\x{00A0}]+$', '') AS body FROM m
""".replace("\\\\", "\\"))
def strip_quoted(t):
    """Mail bodies by the simple rule: up to the first attribution or separator, without quoted lines."""
    d = t("turns").where((text.source_key(F.col("source")) == "mail") & F.col("text").isNotNull())
    return d.select("turn_id", text.strip_quoted(F.col("text")).alias("body"))


# style

_P = "[.,;:!?—\\-()\\[\\]\"'']"
_WORDS = f"list_filter(list_transform(regexp_split_to_array(lower(text), '[\\s\\x0B\\x1c-\\x1f\\x{{0085}}\\x{{00A0}}]+'), lambda w: regexp_replace(regexp_replace(w, '^{_P}+', ''), '{_P}+$', '')), lambda w: w <> '')"


@query(f"SELECT {SRC} AS source, count(*) AS n, round(avg(length(text)), 9) AS mean_len, median(length(text))::DOUBLE AS median_len, round(stddev_pop(length(text)), 9) AS len_stdev, round(stddev_pop(length(text)) / avg(length(text)), 9) AS burstiness FROM turns WHERE text IS NOT NULL GROUP BY 1")
def fingerprint_lengths(t):
    f = _style(t).select("source", "n", "mean_len", "median_len", "len_stdev", "burstiness")
    return _rounded(f, ("mean_len", "len_stdev", "burstiness"))


@query(f"SELECT {SRC} AS source, round(sum(length(regexp_replace(text, '[^.,;:!?—\\-()\\[\\]\"'']', '', 'g'))) / sum(length(text)), 9) AS punct_rate, round(sum(length(regexp_replace(text, '[^\\p{{So}}]', '', 'g'))) / sum(length(text)), 9) AS emoji_rate, round(sum(length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g'))) / sum(length(text)), 9) AS upper_rate FROM turns WHERE text IS NOT NULL GROUP BY 1")
def char_rates(t):
    return _rounded(_style(t).select("source", "punct_rate", "emoji_rate", "upper_rate"), ("punct_rate", "emoji_rate", "upper_rate"))


@query(f"WITH w AS (SELECT {SRC} AS source, unnest({_WORDS}) AS w FROM turns WHERE text IS NOT NULL) SELECT source, round(count(DISTINCT w) / count(*), 9) AS type_token_ratio FROM w GROUP BY 1")
def type_token(t):
    return _rounded(_style(t).select("source", "type_token_ratio"), ("type_token_ratio",))


@query(f"WITH w AS (SELECT {SRC} AS source, unnest({_WORDS}) AS w FROM turns WHERE text IS NOT NULL) SELECT source, " + ", ".join(f"round(count(*) FILTER (w = '{x}') / count(*), 9) AS fw_{x}" for x in text.FUNCTION_WORDS) + " FROM w GROUP BY 1")
def function_words(t):
    f = _style(t).select("source", *[F.col(f"`fw:{x}`").alias(f"fw_{x}") for x in text.FUNCTION_WORDS])
    return _rounded(f, [f"fw_{x}" for x in text.FUNCTION_WORDS])


def _style(t) -> DataFrame:
    d = t("turns").where("text is not null").select(text.source_key(F.col("source")).alias("source"), "text")
    return style.fingerprint(d, "source")


def _rounded(d: DataFrame, cols) -> DataFrame:
    return d.withColumns({c: F.round(c, ROUND) for c in cols})


@query(f"SELECT {SRC} AS source, greatest(1, ceil(count(thread_id) / count(DISTINCT thread_id)))::BIGINT AS cap FROM turns GROUP BY 1")
def thread_mass_cap(t):
    return style.thread_mass_cap(t("turns").withColumn("source", text.source_key(F.col("source"))), "source")


def _drawn_sql(turns: str, seed: int, trials: int, name: str = "x") -> str:
    """CTEs ``<name>`` (trial, turn_id, thread_id, text) of the draws of a relation (turn_id, thread_id, text)."""
    part = lambda at: f"('0x' || substr(sha256('{seed}:draw:' || thread_id), {at}, 8))::BIGINT"
    return (
        f"{name}_c AS (SELECT greatest(1, ceil(count(thread_id) / count(DISTINCT thread_id)))::BIGINT AS cap FROM {turns}), "
        f"{name}_r AS (SELECT turn_id, thread_id, text, row_number() OVER (PARTITION BY thread_id ORDER BY sha256('{seed}:order:' || thread_id || ':' || turn_id)) - 1 AS p, count(*) OVER (PARTITION BY thread_id) AS n, {part(1)} AS start, {part(9)} AS step FROM {turns} WHERE thread_id IS NOT NULL), "
        f"{name} AS (SELECT j AS trial, turn_id, thread_id, text FROM {name}_r, {name}_c, range({trials}) AS g(j) WHERE ((p - start - j * step) % n + n) % n < cap)"
    )


def _fingerprint_sql(rows: str, keys: str, name: str) -> str:
    """A CTE with every field of the fingerprint per group of a relation with ``text``."""
    size = "greatest(sum(length(text)), 1)"
    rate = lambda c: f"sum(length(regexp_replace(text, '[^{c}]', '', 'g'))) / {size}"
    fw = ", ".join(f"count(*) FILTER (w = '{x}') / count(*) AS \"fw:{x}\"" for x in text.FUNCTION_WORDS)
    return (
        f"{name}_a AS (SELECT {keys}, count(*) AS n, avg(length(text)) AS mean_len, median(length(text))::DOUBLE AS median_len, stddev_pop(length(text)) AS len_stdev, CASE WHEN avg(length(text)) > 0 THEN stddev_pop(length(text)) / avg(length(text)) ELSE 0 END AS burstiness, "
        + rate(".,;:!?—\\-()\\[\\]\"''") + " AS punct_rate, " + rate("\\p{So}") + " AS emoji_rate, " + rate("\\p{Lu}") + f" AS upper_rate FROM {rows} GROUP BY {keys}), "
        f"{name}_w AS (SELECT {keys}, unnest({_WORDS}) AS w FROM {rows}), "
        f"{name}_t AS (SELECT {keys}, count(DISTINCT w) / count(*) AS type_token_ratio, {fw} FROM {name}_w GROUP BY {keys}), "
        f"{name} AS (SELECT * FROM {name}_a LEFT JOIN {name}_t USING ({keys}))"
    )


def _distance_sql(a: str, b: str, s: str) -> str:
    f = lambda x, n: f'coalesce({x}."{n}", 0)'
    return " + ".join(
        f"CASE WHEN {f(s, n)} > 0 THEN abs({f(a, n)} - {f(b, n)}) / {f(s, n)} WHEN greatest(abs({f(a, n)}), abs({f(b, n)})) > 0 THEN abs({f(a, n)} - {f(b, n)}) / greatest(abs({f(a, n)}), abs({f(b, n)})) ELSE 0 END" for n in style.FIELDS
    )


@query("WITH s AS (SELECT turn_id, thread_id, text FROM turns WHERE is_subject), " + _drawn_sql("s", 0, 1) + " SELECT turn_id, thread_id FROM x")
def mass_balanced_sample(t):
    d = t("turns").where("is_subject").select("turn_id", "thread_id")
    return style.mass_balanced_sample(d, 0, "turn_id").select("turn_id", "thread_id")


def _subject_heldout(t) -> DataFrame:
    return ops.split_corpus(t("turns"), split_now()).where("split = 'heldout' and is_subject and text is not null").select("turn_id", "thread_id", "text")


_BAND = (
    f"WITH RECURSIVE s AS (SELECT turn_id, thread_id, text FROM turns WHERE is_subject AND text IS NOT NULL AND {SPLIT} = 'heldout'), "
    + _drawn_sql("s", 0, 200)
    + ", z AS (SELECT *, row_number() OVER (PARTITION BY trial ORDER BY sha256('0:half:' || trial || ':' || thread_id)) AS k FROM (SELECT trial, thread_id, count(*) AS size FROM x GROUP BY 1, 2)), "
    "h AS (SELECT trial, k, thread_id, 'left' AS side, size AS l, 0::BIGINT AS r FROM z WHERE k = 1 UNION ALL SELECT z.trial, z.k, z.thread_id, CASE WHEN h.l <= h.r THEN 'left' ELSE 'right' END, CASE WHEN h.l <= h.r THEN h.l + z.size ELSE h.l END, CASE WHEN h.l <= h.r THEN h.r ELSE h.r + z.size END FROM h JOIN z ON z.trial = h.trial AND z.k = h.k + 1), "
    "y AS (SELECT x.trial, side, text FROM x JOIN h USING (trial, thread_id)), "
    + _fingerprint_sql("y", "trial, side", "f")
    + ", m AS (SELECT trial, side, min(thread_id) AS first, sha256(string_agg(thread_id, chr(0) ORDER BY thread_id)) AS threads FROM h GROUP BY 1, 2), "
    "a AS (SELECT f.*, first, threads FROM f JOIN m USING (trial, side) WHERE side = 'left' AND n >= 4), b AS (SELECT f.*, first, threads FROM f JOIN m USING (trial, side) WHERE side = 'right' AND n >= 4), "
    "q AS (SELECT " + ", ".join(f'avg(abs(coalesce(a."{n}", 0) - coalesce(b."{n}", 0))) AS "{n}"' for n in style.FIELDS) + " FROM a JOIN b USING (trial)), "
    "d AS (SELECT CASE WHEN a.first <= b.first THEN a.threads ELSE b.threads END AS split, " + _distance_sql("a", "b", "q") + " AS d FROM a JOIN b USING (trial), q), "
    "o AS (SELECT list_sort(list(d)) AS ds, count(*) AS trials, count(DISTINCT split) AS partitions FROM d), "
    "band AS (SELECT CASE WHEN (SELECT count(*) FROM s) < 8 THEN 'too few turns' WHEN trials = 0 THEN 'no trial gave two halves of enough turns' WHEN partitions < 2 THEN 'the threads admit one split only' ELSE '' END AS reason, * FROM o)"
)


@query(_BAND + " SELECT CASE WHEN reason = '' THEN round(ds[trials // 2 + 1], 6) END AS median, CASE WHEN reason = '' THEN round(ds[floor(trials * 0.95)::BIGINT + 1], 6) END AS p95, trials, partitions, reason FROM band")
def self_distance_band(t):
    return style.self_distance_band(_subject_heldout(t), key="turn_id").select(F.round("median", 6).alias("median"), F.round("p95", 6).alias("p95"), "trials", "partitions", "reason")


@query(
    _BAND + f", u AS (SELECT turn_id, thread_id, text FROM turns WHERE NOT is_subject AND text IS NOT NULL AND {SPLIT} = 'train'), " + _drawn_sql("s", 0, 25, "i") + ", " + _drawn_sql("u", 1, 25, "j") + ", " + _fingerprint_sql("i", "trial", "fi") + ", " + _fingerprint_sql("j", "trial", "fj")
    + " SELECT round(avg(" + _distance_sql("fi", "fj", "q") + "), 6) AS distance, count(*) AS draws FROM fi JOIN fj USING (trial), q WHERE (SELECT reason FROM band) = ''"
)
def corpus_distance(t):
    mine = _subject_heldout(t)
    band = style.self_distance_band(mine, key="turn_id")
    other = ops.split_corpus(t("turns"), split_now()).where("split = 'train' and not is_subject and text is not null").select("turn_id", "thread_id", "text")
    return style.corpus_distance(mine, other, band, 25, 0, "turn_id").select(F.round("distance", 6).alias("distance"), "draws")


# evaluation


def _trial_input(t) -> tuple[DataFrame, DataFrame]:
    p = _pairs(t).select("thread_id", "source", F.col("turn_id").cast("string").alias("source_id"), F.transform("context", lambda x: x["text"]).alias("context"), "text")
    return p, p.select("source", "source_id", F.reverse("text").alias("candidate"))


_TRIALS = PAIRS + ", q AS (SELECT p.turn_id, p.thread_id, u.source, p.turn_id::VARCHAR AS sid FROM p JOIN u USING (turn_id)), h AS (SELECT *, sha256('0:' || thread_id || ':' || source || ':' || sid) AS h FROM q), f AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY thread_id ORDER BY h) = 1)"


@query(_TRIALS + " SELECT substr(sha256(source || ':' || sid), 1, 16) AS trial_id, thread_id, strpos('02468ace', substr(h, 64, 1)) > 0 AS real_is_a FROM f")
def ab_trials(t):
    return ev.build_trials(*_trial_input(t)).select("trial_id", "thread_id", "real_is_a")


@query(_TRIALS + ", g AS (SELECT strpos('02468ace', substr(h, 64, 1)) > 0 AS real_is_a, CASE WHEN substr(sha256(source || ':' || sid), 1, 1) < '8' THEN 'a' ELSE 'b' END AS guess FROM f), s AS (SELECT count(*) AS n, count(*) FILTER (real_is_a = (guess = 'a')) AS correct FROM g) SELECT n, correct, round(correct / n, 9) AS accuracy, round(greatest(0, (correct / n + 3.8416 / (2 * n)) / (1 + 3.8416 / n) - 1.96 / (1 + 3.8416 / n) * sqrt(correct / n * (1 - correct / n) / n + 3.8416 / (4.0 * n * n))), 9) AS ci_low, round(least(1, (correct / n + 3.8416 / (2 * n)) / (1 + 3.8416 / n) + 1.96 / (1 + 3.8416 / n) * sqrt(correct / n * (1 - correct / n) / n + 3.8416 / (4.0 * n * n))), 9) AS ci_high FROM s")
def ab_score(t):
    trials = ev.build_trials(*_trial_input(t))
    guesses = trials.select("trial_id", F.when(F.substring("trial_id", 1, 1) < "8", " A ").otherwise("b").alias("guess"))
    return _rounded(ev.score_trials(trials, guesses), ("accuracy", "ci_low", "ci_high"))


@query("WITH s AS (SELECT lower(trim(source)) AS source, count(*) AS n, count(*) FILTER (is_subject) AS k FROM turns GROUP BY 1) SELECT source, n, k, round(greatest(0, (k / n + 3.8416 / (2 * n)) / (1 + 3.8416 / n) - 1.96 / (1 + 3.8416 / n) * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4.0 * n * n))), 9) AS low, round(least(1, (k / n + 3.8416 / (2 * n)) / (1 + 3.8416 / n) + 1.96 / (1 + 3.8416 / n) * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4.0 * n * n))), 9) AS high FROM s")
def wilson(t):
    d = t("turns").groupBy(text.source_key(F.col("source")).alias("source")).agg(F.count("*").alias("n"), F.count_if("is_subject").alias("k"))
    lo, hi = text.wilson(F.col("k"), F.col("n"))
    return d.select("source", "n", "k", F.round(lo, ROUND).alias("low"), F.round(hi, ROUND).alias("high"))


@query("WITH a AS (SELECT answerable, coalesce(expected, '') AS expected, CASE WHEN item_id % 3 = 0 THEN '' WHEN item_id % 3 = 1 THEN upper(coalesce(expected, '')) || ' ' ELSE 'something else' END AS answer FROM fact_probes) SELECT count(*) AS n, count(*) FILTER (CASE WHEN answerable THEN lower(trim(answer)) = lower(trim(expected)) ELSE trim(answer) = '' END) AS correct, count(*) FILTER (NOT answerable AND trim(answer) <> '') AS fabrications, round(count(*) FILTER (CASE WHEN answerable THEN lower(trim(answer)) = lower(trim(expected)) ELSE trim(answer) = '' END) / count(*), 9) AS accuracy FROM a")
def fact_score(t):
    p = t("fact_probes")
    k = F.col("item_id") % 3
    answers = p.select("probe_id", F.when(k == 0, "").when(k == 1, F.concat(F.upper(F.coalesce("expected", F.lit(""))), F.lit(" "))).otherwise("something else").alias("answer"))
    return _rounded(ev.score_facts(p, answers), ("accuracy",))


@query("SELECT count(*) FILTER ((item_id % 2 = 0) = (NOT answerable)) AS agreed, count(*) AS n, round(count(*) FILTER ((item_id % 2 = 0) = (NOT answerable)) / count(*), 9) AS rate FROM fact_probes")
def refusal_score(t):
    p = t("fact_probes").select("probe_id", "item_id", (~F.col("answerable")).alias("should_decline"))
    return _rounded(ev.score_refusals(p.drop("item_id"), p.select("probe_id", (F.col("item_id") % 2 == 0).alias("declined"))), ("rate",))


_SHAPE = "lower(array_to_string(list_transform(list_filter(list_zip(regexp_extract_all(question, '[A-Za-z0-9.+#-]+'), range(len(regexp_extract_all(question, '[A-Za-z0-9.+#-]+')))), lambda x: x[2] = 0 OR NOT regexp_matches(x[1], '^[A-Z]|[0-9]')), lambda x: x[1]), ' '))"


@query(f"SELECT item_id, {_SHAPE} AS shape FROM fact_probes")
def question_shapes(t):
    return t("fact_probes").select("item_id", text.question_shape(F.col("question")).alias("shape"))


@query(f"WITH s AS (SELECT count(*) AS k FROM fact_probes GROUP BY {_SHAPE}) SELECT count(*) AS n, count(*) FILTER (answerable) AS answerable, count(*) FILTER (NOT answerable) AS unanswerable, round(count(*) FILTER (NOT answerable) / count(*), 9) AS share, round((SELECT max(k) FROM s) / count(*), 9) AS top_shape_share FROM fact_probes")
def probe_composition(t):
    return _rounded(ev.fact_composition(t("fact_probes")).drop("top_shape"), ("share", "top_shape_share"))


_GATES = f"""
WITH s AS (SELECT count(*) AS k FROM fact_probes GROUP BY {_SHAPE}),
a AS (SELECT count(*) AS n, count(*) FILTER (NOT answerable) / count(*) AS share, (SELECT max(k) FROM s) / count(*) AS top FROM fact_probes),
g AS (SELECT 'facts' AS gate, n, round(share, 9) AS share, CASE WHEN n < 200 THEN 'too few probes' WHEN share NOT BETWEEN 0.4 AND 0.6 THEN 'share of unanswerable probes out of range' WHEN top > 0.15 THEN 'one question shape too common' ELSE '' END AS note FROM a
  UNION ALL SELECT 'refusals', n, round(share, 9), CASE WHEN n < 60 THEN 'too few probes' WHEN share NOT BETWEEN 0.4 AND 0.6 THEN 'share of declining probes out of range' ELSE '' END FROM a)
SELECT gate, n, share, note, note = '' AS passed FROM g
"""


@query(_GATES)
def probe_gates(t):
    p = t("fact_probes")
    a = ev.fact_gate(p).select(F.lit("facts").alias("gate"), "n", F.round("share", 9).alias("share"), "note", "passed")
    b = ev.refusal_gate(p.select((~F.col("answerable")).alias("should_decline"))).select(F.lit("refusals").alias("gate"), "n", F.round("share", 9).alias("share"), "note", "passed")
    return a.unionByName(b)


def _entity_sql(tail: str) -> str:
    rows = []
    for e, kind in ENTITIES.items():
        for attr, pattern, _ in ev.ATTRIBUTES.get(kind, []):
            hit = f"regexp_matches(text, '(?i){e}')"
            p = pattern.replace("'", "''")
            rows.append(f"SELECT '{e}' AS entity, '{kind}' AS kind, '{attr}' AS attribute, count(*) FILTER ({hit}) AS entity_hits, count(*) FILTER ({hit} AND regexp_matches(text, '(?i){p}')) AS attribute_hits FROM documents")
    return f"WITH c AS ({' UNION ALL '.join(rows)}) {tail}"


@query(_entity_sql("SELECT * FROM c"))
def entity_counts(t):
    return ev.entity_counts(t("documents"), ENTITIES).select("entity", "kind", "attribute", "entity_hits", "attribute_hits")


@query(_entity_sql("SELECT entity, attribute, entity_hits, attribute_hits FROM c WHERE entity_hits >= 5 AND attribute_hits >= 5"))
def answerable_rows(t):
    return ev.answerable_rows(t("documents"), ENTITIES).drop("question")


_ORDER = "CASE entity " + " ".join(f"WHEN '{e}' THEN {i}" for i, e in enumerate(ENTITIES)) + " END"


@query(_entity_sql(f", r AS (SELECT *, entity_hits >= 5 AND attribute_hits <= 0 AS free FROM c), k AS (SELECT *, row_number() OVER (PARTITION BY attribute, free ORDER BY entity_hits DESC, {_ORDER}) AS rank FROM r) SELECT entity, attribute, entity_hits, attribute_hits, CASE WHEN entity_hits < 5 THEN 'too few hits' WHEN attribute_hits > 0 THEN 'attribute found' WHEN rank > 3 THEN 'over the cap of its shape' END AS skipped FROM k"))
def absences(t):
    return ev.absence_candidates(t("documents"), ENTITIES).select("entity", "attribute", "entity_hits", "attribute_hits", "skipped")


#: Patterns for the worksheet query, in the manner of the fixed ones, that the invented texts can meet.
CLAIMS = {"errands": r"\b(i|we) (carried|planned|borrowed|watered|cleaned)\b", "durations": r"\bit took \d+ (hours|days|weeks)\b", "requests": r"\bcan you\b"}
WITHHELD = r"\b(payment|receipt|claim|invoice)\b"
_LINE = f"trim(regexp_replace(text, '{_S}+', ' ', 'g'))"


@query(
    f"WITH s AS (SELECT *, {SPLIT} AS split FROM turns WHERE text IS NOT NULL), h AS (SELECT DISTINCT {_LINE} AS line FROM s WHERE split <> 'train'), "
    f"l AS (SELECT {_LINE} AS line FROM s WHERE split = 'train'), c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS category, line FROM l WHERE regexp_matches(line, '(?i){p}')" for n, p in CLAIMS.items()) + "), "
    f"k AS (SELECT category, line, regexp_matches(line, '(?i){WITHHELD}') AS bad, substr(regexp_replace(lower(line), '[^a-z0-9 ]', '', 'g'), 1, 90) AS key FROM c WHERE length(line) BETWEEN 80 AND 600 AND line NOT IN (SELECT line FROM h)), "
    "w AS (SELECT category, count(*) FILTER (bad) AS withheld FROM k GROUP BY 1), b AS (SELECT category, line FROM k WHERE NOT bad QUALIFY row_number() OVER (PARTITION BY category, key ORDER BY length(line) DESC, line) = 1), "
    "r AS (SELECT category, line, row_number() OVER (PARTITION BY category ORDER BY length(line) DESC, line) AS rank FROM b) SELECT category, rank, line, withheld FROM r JOIN w USING (category) WHERE rank <= 40"
)
def worksheet_lines(t):
    d = ops.split_corpus(t("turns"), split_now()).where("text is not null")
    x = d.withColumn("source_id", F.col("turn_id").cast("string"))
    return ev.worksheet_lines(x.where("split = 'train'"), x.where("split <> 'train'"), categories=CLAIMS, sensitive=WITHHELD).withColumn("rank", F.col("rank").cast("bigint"))


@query("WITH p AS (SELECT unnest(regexp_extract_all(regexp_replace(text, '[\\p{L}\\p{N}_]*[^\\x00-\\x7F\\PL][\\p{L}\\p{N}_]*', 'x', 'g'), '\\b([A-Z][A-Za-z0-9.+#-]{2,}(?: [A-Z][A-Za-z0-9.+#-]{2,}){0,2})\\b', 1)) AS phrase FROM documents), c AS (SELECT phrase, count(*) AS n FROM p WHERE lower(phrase) NOT IN ('i', 'the', 'this', 'that', 'and') GROUP BY 1 ORDER BY n DESC, phrase LIMIT 120) SELECT phrase, n FROM c WHERE n >= 5 ORDER BY n DESC, phrase LIMIT 40")
def topics(t):
    return ev.topics(t("documents"))


@query("WITH p AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(regexp_replace(lower(question), '[^a-z ]', '', 'g'), ' +'), lambda x: x <> '')) AS w FROM fact_probes) SELECT a.item_id AS a, b.item_id AS b, round(len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))), 9) AS jaccard FROM p a JOIN p b ON a.item_id < b.item_id WHERE len(a.w) > 0 AND len(b.w) > 0 AND len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) >= 0.25")
def near_dup_questions(t):
    return _rounded(ev.near_duplicate_questions(t("fact_probes"), 0.25), ("jaccard",))


_INTAKE = """
WITH RECURSIVE p AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(question, '')), '[^a-z ]', '', 'g'), ' +'), lambda x: x <> '')) AS w, row_number() OVER (ORDER BY item_id) AS i FROM fact_probes),
g AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS item_id, NULL::BOOLEAN AS kept, []::VARCHAR[][] AS words
  UNION ALL SELECT p.i, p.item_id, NOT d.dup, CASE WHEN d.dup THEN g.words ELSE list_append(g.words, p.w) END
  FROM g JOIN p ON p.i = g.i + 1, LATERAL (SELECT len(p.w) > 0 AND len(list_filter(g.words, lambda e: len(e) > 0 AND len(list_intersect(e, p.w)) / (len(e) + len(p.w) - len(list_intersect(e, p.w))) >= 0.25)) > 0 AS dup) d)
SELECT item_id, kept FROM g WHERE i > 0
"""


@query(_INTAKE)
def probe_intake(t):
    """The greedy intake at a threshold that the invented questions reach."""
    return ev.intake(t("fact_probes"), 0.25)


@query()
def claims_recurrence(t):
    """Stand-ins for the claims of two runs: reasons in the ledger against the expected answers of the probes."""
    reason = F.get_json_object("payload", "$.reason")
    a = t("ledger_entries").select(reason.alias("text")).where(~text.is_blank(F.col("text"))).distinct().withColumn("claim_id", text.short_hash(16, F.col("text")))
    return _rounded(ev.claim_recurrence(a, t("fact_probes").where("answerable").select(F.col("expected").alias("text"))), ("best",))


# provenance


@query("WITH RECURSIVE l AS (SELECT entry_id AS entry, unnest(parents) AS parent FROM ledger_entries), s AS (SELECT entry_id AS start FROM ledger_entries WHERE kind = 'supersede'), w AS (SELECT start, start AS entry, 0 AS depth FROM s UNION SELECT w.start, l.parent, w.depth + 1 FROM w JOIN l ON l.entry = w.entry WHERE w.depth < 200) SELECT start, entry, min(depth) AS depth FROM w WHERE entry IN (SELECT entry_id FROM ledger_entries) GROUP BY 1, 2")
def ledger_provenance(t):
    """What every superseding entry rests on."""
    e = t("ledger_entries")
    return provenance.ancestors(e, e.where("kind = 'supersede'").select(F.col("entry_id").alias("start")), strict=False)


@query("SELECT kind, count(*) AS n, count(*) FILTER (len(parents) = 0) AS roots, count(*) FILTER (coalesce(json_extract_string(payload, '$.reason'), '') = '') AS without_reason FROM ledger_entries GROUP BY 1")
def ledger_kinds(t):
    e = t("ledger_entries")
    reason = F.coalesce(F.get_json_object("payload", "$.reason"), F.lit(""))
    return e.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(F.size("parents") == 0).alias("roots"), F.count_if(reason == "").alias("without_reason"))


@query("""
WITH RECURSIVE d AS (SELECT source_id, ts, payload FROM envelopes WHERE lower(trim(source)) = 'chatgpt' AND json_valid(payload) AND payload LIKE '{%' QUALIFY row_number() OVER (PARTITION BY subject_id, source, source_id ORDER BY ingested_at, ts, payload) = 1),
n AS (SELECT payload ->> '$.conversation_id' AS c, source_id AS id, payload ->> '$.parent' AS parent, ts FROM d WHERE payload ->> '$.conversation_id' IS NOT NULL),
w AS (SELECT c, id, parent, [id] AS path FROM n QUALIFY row_number() OVER (PARTITION BY c ORDER BY ts DESC, id DESC) = 1
  UNION ALL SELECT n.c, n.id, n.parent, [n.id] || w.path FROM w JOIN n ON n.c = w.c AND n.id = w.parent WHERE NOT list_contains(w.path, n.id))
SELECT c AS conversation_id, unnest(path) AS id, unnest(range(1, len(path) + 1)) AS pos FROM w QUALIFY len(path) = max(len(path)) OVER (PARTITION BY c)
""")
def live_branches(t):
    """Conversations of the DAG source, walked from their newest message to the root; payloads that are no objects have no node."""
    e = ops.vault_dedupe(t("envelopes").where(text.source_key(F.col("source")) == "chatgpt"))
    e = e.withColumn("p", F.from_json("payload", "map<string,string>", {"allowSingleQuotes": "false"})).withColumn("conversation_id", F.col("p")["conversation_id"]).where("conversation_id is not null")
    nodes = e.select("conversation_id", F.col("source_id").alias("id"), F.col("p")["parent"].alias("parent"), "ts")
    newest = nodes.groupBy("conversation_id").agg(F.max(F.struct("ts", "id"))["id"].alias("id"))
    return provenance.live_branch_rows(nodes, newest).withColumn("pos", F.col("pos").cast("bigint"))


def queries() -> dict[str, Query]:
    from threadloom import file_queries  # noqa: F401  # adds those of sources and stores

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from threadloom import file_queries  # noqa: F401

    return dict(SQL)
