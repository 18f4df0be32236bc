"""Secrets in texts: fixed patterns, and strings that a tokenizer finds hard.

Natural words take few tokens, random strings take many: a run of key characters whose characters-per-token ratio under
a public vocabulary is low is reported as `random`. Where a run as a whole is not, its stretches between separators are
looked at, so that a key behind a path or a name is found. Known digests (hex lengths, base64 behind the name of an
algorithm, content ids) and identifiers (UUIDs, IBANs with the right remainder, dates with times, numbers) are cut out of a
run first, and what is mostly separators is left out. The fixed patterns report what they match in any case.

Each row is handled on its own, in Arrow batches of few rows. Nulls: a null text is empty. Repeated rows give equal
rows; an empty table gives none; only the id and the text column are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from runlens.llm.common import id_text, small_batches

# fixed values: the patterns of the base kinds, with the least length that counts
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINT = re.compile(r"pass|secret|token|api", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

LEAST = 16
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
PART = re.compile(r"[A-Za-z0-9]+")

# fixed values: what is known although it looks random; whole parts between other characters
_BASE64 = r"(?:1[-:][A-Za-z0-9+/_-]{27}=?|224[-:][A-Za-z0-9+/_-]{38}(?:==)?|256[-:][A-Za-z0-9+/_-]{43}=?|384[-:][A-Za-z0-9+/_-]{64}|512[-:][A-Za-z0-9+/_-]{86}(?:==)?)"
_DAY = r"(?:19|20)[0-9]{2}(-?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01])"
_TIME = r"(?:[Tt_-]?(?:[01][0-9]|2[0-3])(-?)[0-5][0-9](?:\2[0-5][0-9](?:[_-]?[0-9]{3})?)?[Zz]?)?"
IDENTIFIERS = (
    re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I),  # UUID
    re.compile(r"(?:[0-9a-f]{128}|[0-9a-f]{96}|[0-9a-f]{64}|[0-9a-f]{56}|[0-9a-f]{40}|[0-9a-f]{32})", re.I),  # hex digest
    re.compile(rf"(?:sha|SHA){_BASE64}"),  # digest in base64
    re.compile(r"(?:Qm[1-9A-HJ-NP-Za-km-z]{44}|baf[a-z2-7]{56})"),  # content id
    re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"),  # IBAN, if its remainder is right
    re.compile(_DAY + _TIME),
)
_IBAN = IDENTIFIERS[4]
_INSIDE = tuple(re.compile(rf"(?<![A-Za-z0-9])(?:{p.pattern})(?![A-Za-z0-9])", p.flags) for p in IDENTIFIERS)
PREFIX = re.compile(r"(?<![A-Za-z0-9])(?:sha|SHA)(?:1|224|256|384|512):$")
IDENTIFIER = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)(?:[-_/=+]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+))*")
CHARS_PER_TOKEN = 2.2
VOCABULARY = "byte_bpe_50k.tiktoken"


def encoder(name: str = VOCABULARY):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


_encoders: dict = {}  # one per worker


def _encoder(name: str):
    if name not in _encoders:
        _encoders[name] = encoder(name)
    return _encoders[name]


def _iban(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def identifiers(run: str) -> list[tuple[int, int]]:
    """Known digests and identifiers inside a run, sorted and apart."""
    found = sorted(m.span() for p, inside in zip(IDENTIFIERS, _INSIDE, strict=True) for m in inside.finditer(run) if p is not _IBAN or _iban(m[0]))
    apart: list[tuple[int, int]] = []
    for a, b in found:
        if apart and a < apart[-1][1]:
            apart[-1] = (apart[-1][0], max(b, apart[-1][1]))
        else:
            apart.append((a, b))
    return apart


def is_random(run: str, vocabulary: str = VOCABULARY, limit: float = CHARS_PER_TOKEN) -> bool:
    if not re.search("[A-Za-z]", run):
        return False
    # a random string has few separators
    if 3 * sum(map(len, PART.findall(run))) < 2 * len(run):
        return False
    # words joined by separators count without them
    words = PART.findall(run) if IDENTIFIER.fullmatch(run) else [run]
    return sum(map(len, words)) / sum(len(_encoder(vocabulary).encode_ordinary(w)) for w in words) < limit


def _stretches(run: str, vocabulary: str, limit: float) -> list[tuple[int, int]]:
    """Stretches of whole parts of a run, from separator to separator, that take the most tokens beyond length / limit
    (all maximal scoring ones, found in one pass)."""
    # stretches so far: start, end, score before, score after
    kept: list[tuple[int, int, float, float]] = []
    score, at = 0.0, 0
    for m in PART.finditer(run):
        score -= m.start() - at  # a separator costs its length, as if it took no token
        gain = limit * len(_encoder(vocabulary).encode_ordinary(m[0])) - len(m[0])
        before, score, at = score, score + gain, m.end()
        if gain <= 0:
            continue
        new = (m.start(), m.end(), before, score)
        while True:
            j = next((j for j in range(len(kept) - 1, -1, -1) if kept[j][2] < new[2]), None)
            if j is None or kept[j][3] >= new[3]:
                kept.append(new)
                break
            new = (kept[j][0], new[1], kept[j][2], new[3])
            del kept[j:]
    return [x[:2] for x in kept]


def random_spans(run: str, vocabulary: str = VOCABULARY, limit: float = CHARS_PER_TOKEN) -> list[tuple[int, int]]:
    """(start, end) of what is random in a run of key characters beside known digests and identifiers: all of it, or
    stretches of its parts."""
    out, at = [], 0
    for a, b in [*identifiers(run), (len(run), len(run))]:
        piece = run[at:a]
        # a piece beside a known part has the separator between them, which belongs to neither
        head = len(piece) - len(piece.lstrip("/_=+-")) if at else 0
        tail = len(piece.rstrip("/_=+-")) if a < len(run) else len(piece)
        whole, start = piece[head:tail], at + head
        if len(whole) >= LEAST and is_random(whole, vocabulary, limit):
            out.append((start, start + len(whole)))
        elif len(whole) >= LEAST:
            out += [(start + x, start + y) for x, y in _stretches(whole, vocabulary, limit)
                    if y - x >= LEAST and is_random(whole[x:y], vocabulary, limit)]
        at = b
    return out


def spans(text: str, vocabulary: str = VOCABULARY, limit: float = CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    """(start, position in KINDS, end) in code points, sorted."""
    found = []
    if ASSIGN_HINT.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for m in RUN.finditer(text):
        # the algorithm of a digest is outside the run where a colon stands behind it
        ahead = PREFIX.search(text, max(0, m.start() - 8), m.start())
        digest = _INSIDE[2].match(text, ahead.start()) if ahead else None
        start = digest.end() if digest else m.start()
        found += [(start + a, 3, start + b) for a, b in random_spans(text[start:m.end()], vocabulary, limit)]
    return sorted(found)


def _listed(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
         limit: float = CHARS_PER_TOKEN) -> DataFrame:
    """One row per input row: id, number of spans of each kind, digest of the base spans, all spans."""
    small_batches(docs.sparkSession)
    rows = id_text(docs, id_col, text_col)
    kind = dict(rows.dtypes)["_id"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [spans(t, vocabulary, limit) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(k == i for _, k, _ in f) for f in found], pa.int64()) for i in range(len(KINDS))]
            base = [hashlib.sha256(_listed([x for x in f if x[1] < 3]).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(base, pa.string()), pa.array(list(map(_listed, found)), pa.string())],
                names=[id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    numbers = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(batches, f"`{id_col}` {kind}, {numbers}, base_sha256 string, spans string")
