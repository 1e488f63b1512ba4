"""Personal data by weak supervision.

Exact patterns give the base spans. Looser patterns give candidates besides: mail addresses with
their signs spelt out, telephone numbers in national form, cards with other separators, long
addresses. Labelers vote yes or no on every span, base or not, or abstain: gazetteers (top-level domains,
country and area codes, issuer digits, reserved networks), the nearest telling word to the left, what touches
the span, and how a candidate is written. How often each combination of votes and features occurs is counted over all documents; the
combinations are few, whatever the corpus. On these counts expectation-maximisation estimates each
labeler's reliability, from base spans and candidates together, and each combination's probability; those of the
candidates train a logistic classifier over votes and features, which is not told what is a base span. A candidate
it finds likely enough joins the base spans, unless it overlaps one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.llm.common import map_batches, table, texts_of

KINDS = ("email", "ip", "card", "phone")
MIN_PROBABILITY = 0.9
CONTEXT_CHARS = 40

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ANY_DIGIT = re.compile(r"[0-9]")
SPELT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:[(\[{]at[)\]}]|@)\s?[A-Za-z0-9-]{1,63}"
    r"(?:\s?(?:[(\[{]dot[)\]}]|\.)\s?[A-Za-z0-9-]{2,63}){1,4}", re.IGNORECASE)
NATIONAL = re.compile(r"(?<![0-9+])(?:00[1-9][0-9]{0,2}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
SPACED_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:(?:[./_]| {2,3}| - )[0-9]{4}){2,3}(?![0-9])")
LONG_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")

#: What the gazetteers and the context labelers know.
TOP_DOMAINS = {"com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "us", "eu", "it", "nl", "ch"}
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49",
                 "52", "54", "55", "61", "62", "63", "64", "65", "81", "82", "86", "90", "91", "351", "353", "358", "420")
CUES = {
    "email": ("mail", "contact", "write", "correo", "courriel", "kontakt"),
    "ip": ("ip", "host", "server", "address", "adresse", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "appel", "llama"),
}
COUNTER_CUES = ("version", "isbn", "order", "token", "section", "serial", "invoice", "id")

Span = tuple[int, int, int]  # kind, start, end


def passes_luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from the signs: the local part is the run before one."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield 0, start, domain.end()
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    found = list(emails(text)) if "@" in text else []
    if not ANY_DIGIT.search(text):
        return found
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            found.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(map(m[0].count, "0123456789")) <= 15:
            found.append((3, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], s[0]))


def loose_spans(text: str, base: list[Span]) -> list[Span]:
    """Candidates that no base span and no earlier candidate overlaps, in order."""
    found = []
    lower = text.lower()
    if "@" in text or "at)" in lower or "at]" in lower or "at}" in lower:
        found += [(0, m.start(), m.end()) for m in SPELT.finditer(text)]
    if ANY_DIGIT.search(text):
        found += [(1, m.start(), m.end()) for m in LONG_IP.finditer(text)]
        found += [(2, m.start(), m.end()) for m in SPACED_CARD.finditer(text) if passes_luhn(digits_of(m[0]))]
        found += [(3, m.start(), m.end()) for m in NATIONAL.finditer(text)]
    if not found:
        return []
    taken = [(s, e) for _, s, e in base]
    out = []
    for span in sorted(found, key=lambda s: (s[1], s[0])):
        if all(span[2] <= s or e <= span[1] for s, e in taken):
            out.append(span)
            taken.append(span[1:])
    return out


def known_vote(name: str, value: str) -> int:
    """What a gazetteer says of a value: 1 in use, 0 not in use, 2 nothing."""
    digits = digits_of(value)
    if name == "email":
        return int(re.split(r"[^A-Za-z0-9-]+", value)[-1].lower() in TOP_DOMAINS)
    if name == "ip" and ":" in value:
        return int(value[0] in "23" and len(value.split(":")[0]) == 4)  # the block of global addresses
    if name == "ip":
        return int(0 < int(value.split(".")[0][-3:]) < 224)
    if name == "card":
        return int(digits[0] in "23456")
    if value[0] == "+":
        return int(digits.startswith(COUNTRY_CODES))
    if value.startswith("00"):
        return int(digits[2:].startswith(COUNTRY_CODES))
    area, office = digits[-10:-7], digits[-7:-4]
    return 2 if "555" in (area, office) else int(area[0] not in "01" and office[0] not in "01")


def form_vote(name: str, value: str, is_base: bool) -> int:
    """What the way of writing says of a candidate; base spans have theirs by definition."""
    if is_base:
        return 2
    if name == "email":  # nobody spells out the signs of what is no address; a sign among spaces may be anything
        return 1 if value.count("(") + value.count("[") + value.count("{") > 1 else 0 if " @ " in value else 2
    if name == "phone":
        return 1 if "(" in value or value.startswith("00") else 2
    if name == "card":
        return int(len(digits_of(value)) == 16 and len({c for c in value if not c.isalnum()}) == 1)
    return 2


def context_vote(name: str, left: str) -> int:
    """What the words before a span say: the nearest one that says anything, counter-cues among the last two only."""
    for place, word in enumerate(reversed(re.findall(r"[a-z]+", left.lower()))):
        if place < 2 and word in COUNTER_CUES:
            return 0
        if word.startswith(CUES[name]):
            return 1
    return 2


def votes_of(text: str, span: Span, is_base: bool) -> tuple[int, ...]:
    """kind, whether it is a base span, four votes (1 yes, 0 no, 2 none) and two features."""
    kind, start, end = span
    value, name = text[start:end], KINDS[kind]
    context = context_vote(name, text[max(0, start - CONTEXT_CHARS) : start])
    touched = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    separators = min(3, sum(not c.isalnum() for c in value))
    return (kind, int(is_base), known_vote(name, value), context, 0 if touched else 2, form_vote(name, value, is_base),
            min(5, len(digits_of(value)) // 4), separators)


#: How often a labeler says yes of what is personal data and of what is not, before any count.
BELIEFS = ((0.85, 0.2), (0.95, 0.05), (0.9, 0.5), (0.9, 0.1))  # gazetteer, context, apart, form
VOTES = slice(2, 6)
BASE_PRIOR, PRIOR = 0.99, 0.5


def reliabilities(rows: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """The probability that each combination of one kind is personal data, by expectation-maximisation
    over labelers of unknown reliability (Dawid and Skene); a labeler may abstain.

    Base spans and candidates share the labelers. Their priors differ and stay, so that candidates owe
    nothing to how many base spans there are; a labeler that says the same of everything tells nothing in the end. What
    is believed of a labeler weighs as much as the votes on candidates, and base spans together as much as all candidates.
    """
    base = rows[:, 1] == 1
    votes = rows[:, VOTES]
    candidates = counts[~base].sum()
    weights = np.where(base, counts * min(1, candidates / max(counts[base].sum(), 1)), counts)
    prior = np.where(base, BASE_PRIOR, PRIOR)
    rates = np.array(BELIEFS)
    for _ in range(rounds):
        logit = np.log(prior / (1 - prior))
        for (hit, false), vote in zip(rates, votes.T):
            logit = logit + np.where(vote == 1, np.log(hit / false), np.where(vote == 0, np.log((1 - hit) / (1 - false)), 0))
        truth = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        for j, vote in enumerate(votes.T):
            strength = 10 + weights[(vote < 2) & ~base].sum()
            for side, share in enumerate((truth, 1 - truth)):
                cast, yes = (weights * share)[vote < 2].sum(), (weights * share)[vote == 1].sum()
                rates[j, side] = (yes + BELIEFS[j][side] * strength) / (cast + strength)
    return truth


def design(rows: np.ndarray) -> np.ndarray:
    """One column for each kind, each value of a vote and each value of a feature; not whether it is a base span."""
    blocks = [(rows[:, 0:1] == np.arange(len(KINDS)))]
    blocks += [rows[:, j : j + 1] == np.arange(3) for j in range(VOTES.start, VOTES.stop)]
    blocks += [rows[:, 6:7] == np.arange(6), rows[:, 7:8] == np.arange(4), np.ones((len(rows), 1), bool)]
    return np.concatenate(blocks, axis=1).astype(float)


def fit_classifier(rows: np.ndarray, counts: np.ndarray, truth: np.ndarray, rounds: int = 50, ridge: float = 0.1) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression on soft labels, by Newton steps."""
    x = design(rows)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts * (truth - p)) - ridge * w
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return w


VOTE_NAMES = ("kind", "strict", "known", "context", "apart", "form", "digits", "separators")


def vote_counts(docs: DataFrame) -> DataFrame:
    """How often each combination of votes and features occurs, over all texts."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for text in texts_of(batch.column(0)):
            base = base_spans(text)
            rows += [votes_of(text, s, True) for s in base]
            rows += [votes_of(text, s, False) for s in loose_spans(text, base)]
        if rows:
            unique, counts = np.unique(np.array(rows, np.int32), axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(unique[:, j]) for j in range(unique.shape[1])), pa.array(counts)], [*VOTE_NAMES, "n"])

    schema = ", ".join(f"{name} int" for name in VOTE_NAMES) + ", n bigint"
    counted = map_batches(docs.select(F.col("text").cast("string").alias("text")), work, schema)
    return counted.groupBy(*VOTE_NAMES).agg(F.sum("n").alias("n"))


def learnt(rows: np.ndarray, counts: np.ndarray) -> np.ndarray | None:
    """The classifier's weights from combinations and how often each occurs; None without candidates.

    Reliabilities come from base spans and candidates, the classifier from candidates, which are all it is asked about.
    """
    candidates = rows[:, 1] == 0
    if not candidates.any():
        return None
    truth = np.zeros(len(rows))
    for kind in range(len(KINDS)):
        own = rows[:, 0] == kind
        if own.any():
            truth[own] = reliabilities(rows[own], counts[own])
    return fit_classifier(rows[candidates], counts[candidates], truth[candidates])


def learn(docs: DataFrame) -> np.ndarray | None:
    """The classifier's weights; None where there is nothing to decide about.

    What comes to the driver is one row for each combination of votes and features, 10,368 at most.
    """
    found = sorted(vote_counts(docs).collect())
    rows = np.array([r[:-1] for r in found], np.int64).reshape(-1, len(VOTE_NAMES))
    return learnt(rows, np.array([r[-1] for r in found], float))


def all_spans(text: str, weights: np.ndarray | None, least: float) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added ones, by start and kind."""
    base = base_spans(text)
    loose = loose_spans(text, base)
    if not loose or weights is None:
        return base, base
    scores = design(np.array([votes_of(text, s, False) for s in loose])) @ weights
    added = [s for s, score in zip(loose, scores) if 1 / (1 + np.exp(-score)) >= least]
    return base, sorted(base + added, key=lambda s: (s[1], s[0]))


def named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, or group of overlapping spans, replaced by its first one's kind."""
    out, until = [], 0
    for kind, start, end in spans:
        if start >= until:
            out += [text[until:start], f"[{KINDS[kind].upper()}]"]
        until = max(until, end)
    return "".join([*out, text[until:]])


REPORT = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
)


def report_column(text: Column, weights: np.ndarray | None, least: float) -> Column:
    def run(batch: pa.Array) -> pa.Array:
        rows = []
        for value in texts_of(batch):
            base, spans = all_spans(value, weights, least)
            kinds = [s[0] for s in base]
            digest = hashlib.sha256(named(base).encode()).hexdigest()
            rows.append((*(kinds.count(k) for k in range(len(KINDS))), digest, named(spans)))
        columns = list(zip(*rows)) or [[]] * 6
        types = [pa.int64()] * 4 + [pa.string()] * 2
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], REPORT.names)

    return F.arrow_udf(run, REPORT)(text.cast("string"))


def mask_column(text: Column, weights: np.ndarray | None, least: float) -> Column:
    def run(batch: pa.Array) -> pa.Array:
        values = batch.to_pylist()
        return pa.array([v if v is None else masked(v, all_spans(v, weights, least)[1]) for v in values], pa.string())

    return F.arrow_udf(run, T.StringType())(text.cast("string"))


def find_personal_data(docs: DataFrame, least: float = MIN_PROBABILITY) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row for each row of `docs`.

    Null and empty texts have no spans; places are code points of the whole text; repeated rows count
    and stay; an empty table learns nothing and gives no rows; other columns are ignored.
    """
    weights = learn(docs)
    return docs.select("doc_id", report_column(F.col("text"), weights, least).alias("_r")).select("doc_id", "_r.*")


def mask_personal_data(docs: DataFrame, least: float = MIN_PROBABILITY) -> DataFrame:
    """`docs` with the spans in `text` replaced by their kind, and n_chars, if there, renewed."""
    out = docs.withColumn("text", mask_column(F.col("text"), learn(docs), least))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
