"""Secret spans: fixed patterns plus a token-efficiency test.

Ordinary words are cheap for a byte-pair vocabulary (four or more characters a
token); random strings are not (two or fewer). Every run of key characters
that is long enough is tokenised with the tiktoken vocabulary, and a run with
few characters per token is a secret of kind ``token``, unless it is a plain
number or an identifier: words joined by _ - / or camel case, each of them cheap
in tokens itself. Known digests (hex of an md5/sha length) and UUIDs are cut out
of a run first. What is left is tested as a whole and, if that is no secret,
part by part between / and =; a dot always parts. Runs from 12 characters on are tested;
below 20, where a token more or less counts for much, the limit is lower, and
lowest for runs of letters in one case, since rare words look alike.

Defined results: a null text is empty and has no spans; every row is scanned
on its own, whole, so repeated rows give equal rows and an empty table none.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import texts_in_steps

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
KINDS = ("assign", "access", "hex", "token")
#: Hex lengths of md5, sha1, sha224, sha256, sha384, sha512.
DIGESTS = {32, 40, 56, 64, 96, 128}
#: Digests and UUIDs, each with one mark on either side.
KNOWN = re.compile(r"[/=_-]?(?<![0-9A-Za-z])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|%s)(?![0-9A-Za-z])[/=_-]?" % "|".join("[0-9a-f]{%d}" % n for n in sorted(DIGESTS, reverse=True)))
PART = re.compile(r"[^/=]+")
#: Runs shorter than MIN_CHARS are not tested; those shorter than LONG meet a lower limit.
MIN_CHARS, LONG = 12, 20
#: What is taken off the limit for a short run, for one of letters in one case (first letter aside), which
#: a rare word may be as well, and for several such parts joined by marks, as in names of constants.
SHORT_LESS, WORDLIKE_LESS, JOINED_LESS = 0.2, 0.5, 0.8
ONE_CASE = re.compile(r"[A-Za-z]?(?:[a-z]+|[A-Z]+)")
SEGMENT = re.compile(r"[A-Za-z0-9]+")
WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
#: A word of an identifier has more characters per token than this.
WORD_CHARS_PER_TOKEN = 2.5
MAX_CHARS_PER_TOKEN = 2.1
Span = tuple[str, int, int]


@functools.cache
def encoding(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def base_spans(text: str) -> list[Span]:
    """The fixed patterns, leftmost non-overlapping per kind. The quantified forms of
    ACCESS and HEX equal "match, then drop what is too short" since a run's first match is its longest."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def is_identifier(run: str, tokens: Callable[[str], int]) -> bool:
    """Plain numbers, and runs that are mostly words: letters that are cheap in tokens themselves. What stands between marks with under four characters is no reason against."""
    if run.isdigit() or len(set(run)) < 8:
        return True
    in_words, rest = 0, 0
    for segment in SEGMENT.findall(run):
        for part in WORD_PARTS.findall(segment):
            if len(part) >= 4 and part.isalpha() and len(part) > WORD_CHARS_PER_TOKEN * min(map(tokens, (part, part.lower(), " " + part.lower()))):
                in_words += len(part)
            elif len(segment) >= 4:
                rest += len(part)
            elif segment.isalpha() and tokens(segment) == 1:
                in_words += len(part)
    return in_words > 0 and in_words >= 0.7 * (in_words + rest)


def limit_of(run: str, limit: float) -> float:
    """The characters per token that a random run of this kind stays below; 0 for short runs of digits, such as dates."""
    if len(run) >= LONG:
        return limit
    letters = sum(map(str.isalpha, run))
    if letters < 4:
        return 0.0
    segments = SEGMENT.findall(run)
    if not all(map(ONE_CASE.fullmatch, segments)):
        return limit - SHORT_LESS
    return limit - (JOINED_LESS if len(segments) > 1 else WORDLIKE_LESS)


def token_spans(text: str, path: str, limit: float = MAX_CHARS_PER_TOKEN) -> list[Span]:
    def tokens(s: str) -> int:
        return len(encoding(path).encode_ordinary(s))

    def random(s: str) -> bool:
        return len(s) >= MIN_CHARS and len(s) < limit_of(s, limit) * tokens(s) and not is_identifier(s, tokens)

    out = []
    for m in RUN.finditer(text):
        edges = [m.start(), *(m.start() + x for k in KNOWN.finditer(m[0]) for x in k.span()), m.end()]
        for start, end in zip(edges[::2], edges[1::2]):
            if random(text[start:end]):
                out.append(("token", start, end))
            else:
                out += [("token", *p.span()) for p in PART.finditer(text, start, end) if p.span() != (start, end) and random(p[0])]
    return out


def joined(spans: list[Span], kinds: tuple[str, ...]) -> str:
    rank = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], rank[x[0]], x[2])))


def scan(text: str, path: str, limit: float = MAX_CHARS_PER_TOKEN) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans). An added span that a base span already covers is left out."""
    base = base_spans(text)
    return base, [x for x in token_spans(text, path, limit) if not any(b[1] <= x[1] and x[2] <= b[2] for b in base)]


def find_secrets(docs: DataFrame, path: str | None = None, limit: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """doc_id, the number of base spans of each kind and of added ones, digest of the base spans, all spans as text."""
    path = path or vocabulary()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = rows.select("doc_id").schema
    for name, kind in (("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"), ("n_token", "long"), ("base_sha256", "string"), ("spans", "string")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in texts_in_steps(batches):
            out: list[list] = [[] for _ in range(6)]
            for t in texts:
                base, added = scan(t, path, limit)
                for j, k in enumerate(KINDS):
                    out[j].append(sum(s[0] == k for s in base + added))
                out[4].append(hashlib.sha256(joined(base, KINDS).encode()).hexdigest())
                out[5].append(joined(base + added, KINDS))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(x, pa.int64()) for x in out[:4]), *(pa.array(x, pa.string()) for x in out[4:])], names=schema.names)

    return rows.mapInArrow(run, schema)
