"""Personal data: fixed patterns plus a character-level BiLSTM-CRF.

The patterns (email, ip, card, phone) always count. They also label the
training data: windows of text around their matches, drawn from a bounded
sample of documents (SAMPLE_DOCS, TRAIN_WINDOWS), some rewritten to forms the
patterns miss (phone numbers without +, cards with other separators), and windows
around other digits as counter-examples. A bidirectional LSTM with CRF
transitions is trained on them in numpy on the driver (a few seconds, seeded)
and adds spans:

* no span can do without a digit or an @, so only text within CONTEXT
  characters of one, and all of the run without white space that it stands in,
  is decoded;
* such a region is cut into overlapping windows; each character's tag scores
  are averaged over its windows, weighted towards their middle, and one
  Viterbi pass over the whole region reconciles them. A long region is streamed:
  scores come batch by batch, and tags leave as soon as no later score can change them;
* a decoded span must have the form of its kind (digit count, check digit,
  octets) and must not overlap a pattern's span, which always stays.

Defined results: a null text is empty and has no spans; rows are scanned one by
one, whole, so repeated rows give equal rows and an empty table none; with no
labelled span to learn from, nothing is added.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.llm.common import hash_share, texts_in_steps

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]
DIGIT, TRIGGER, SPACE = re.compile("[0-9]"), re.compile("[0-9@]+"), re.compile(r"\s")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match never starts within digits, so the look-behind only saves time on long numbers.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SAMPLE_DOCS, TRAIN_WINDOWS = 20_000, 1200
#: Windows without a span that a sampled document gives at most.
COUNTER_EXAMPLES = 3
WINDOW, STRIDE, CONTEXT = 64, 32, 28
SHOWN = "abcdefghijklmnopqrstuvwxyz@.+-() _%:/,'\"\n=#$&*!"
HIDDEN, EMBED = 16, 12
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))


# Patterns -----------------------------------------------------------------------------------------------
def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(ch for ch in s if "0" <= ch <= "9")


def emails(text: str) -> Iterator[Span]:
    """Leftmost non-overlapping matches, looked for at each @: the local part is the run of its characters before it."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    out = list(emails(text))
    if DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = only_digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(only_digits(m[0])) <= 15]
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


# Model --------------------------------------------------------------------------------------------------
_CODE = {ch: i + 4 for i, ch in enumerate(SHOWN)}
N_CODES = len(SHOWN) + 4


def codes(text: str) -> list[int]:
    """0 padding, 1 digit, 2 capital, 3 anything else, then the shown characters."""
    return [1 if "0" <= ch <= "9" else 2 if "A" <= ch <= "Z" else _CODE.get(ch, 3) for ch in text]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Tagger:
    """Embedding, one LSTM each way, linear scores per tag, CRF transitions."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        small = lambda *shape: rng.normal(0, 0.2, shape)
        self.p = {"embed": small(N_CODES, EMBED), "out": small(2 * HIDDEN, len(TAGS)), "bias": np.zeros(len(TAGS)), "move": np.zeros((len(TAGS), len(TAGS)))}
        for way in ("f", "b"):
            self.p[f"w{way}"], self.p[f"c{way}"] = small(EMBED + HIDDEN, 4 * HIDDEN), np.zeros(4 * HIDDEN)
            self.p[f"c{way}"][HIDDEN:2 * HIDDEN] = 1.0  # remember at first

    def _run(self, x: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        """Hidden states [time, row, hidden] of one direction, and what the way back needs."""
        steps, rows, _ = x.shape
        h, c, out, kept = np.zeros((rows, HIDDEN)), np.zeros((rows, HIDDEN)), np.zeros((steps, rows, HIDDEN)), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = np.concatenate([x[t], h], axis=1)
            g = z @ self.p[f"w{way}"] + self.p[f"c{way}"]
            i, f, o = _sigmoid(g[:, :HIDDEN]), _sigmoid(g[:, HIDDEN:2 * HIDDEN]), _sigmoid(g[:, 2 * HIDDEN:3 * HIDDEN])
            n = np.tanh(g[:, 3 * HIDDEN:])
            before, c = c, f * c + i * n
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            kept.append((t, z, i, f, o, n, before, tc))
        return out, kept

    def _back(self, kept: list, way: str, dout: np.ndarray, grad: dict) -> np.ndarray:
        w, dx = self.p[f"w{way}"], np.zeros((len(dout), dout.shape[1], EMBED))
        dh, dc = np.zeros_like(dout[0]), np.zeros_like(dout[0])
        for t, z, i, f, o, n, before, tc in reversed(kept):
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - tc * tc)
            dg = np.concatenate([dc * n * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - n * n)], axis=1)
            grad[f"w{way}"] += z.T @ dg
            grad[f"c{way}"] += dg.sum(axis=0)
            dz = dg @ w.T
            dx[t], dh, dc = dz[:, :EMBED], dz[:, EMBED:], dc * f
        return dx

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Tag scores [row, time, tag] of windows [row, time]."""
        x = self.p["embed"][ids.T]
        h = np.concatenate([self._run(x, "f")[0], self._run(x, "b")[0]], axis=2)
        return (h @ self.p["out"] + self.p["bias"]).transpose(1, 0, 2)

    def train(self, ids: np.ndarray, tags: np.ndarray, steps: int = 250, rate: float = 0.02, batch: int = 48, seed: int = 5) -> None:
        rng, moment, square, step = np.random.default_rng(seed), {}, {}, 0
        while step < steps:
            order = rng.permutation(len(ids))
            for at in range(0, len(order), batch):
                grad = self._gradient(ids[order[at:at + batch]], tags[order[at:at + batch]])
                step += 1
                for k, g in grad.items():
                    g = np.clip(g, -5, 5)
                    moment[k] = 0.9 * moment.get(k, 0) + 0.1 * g
                    square[k] = 0.99 * square.get(k, 0) + 0.01 * g * g
                    self.p[k] -= rate * (moment[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)

    def _gradient(self, ids: np.ndarray, tags: np.ndarray) -> dict:
        """Of the mean negative log-likelihood of the tag sequences."""
        rows, steps = ids.shape
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        x = self.p["embed"][ids.T]
        hf, kf = self._run(x, "f")
        hb, kb = self._run(x, "b")
        h = np.concatenate([hf, hb], axis=2)
        e, move = h @ self.p["out"] + self.p["bias"], self.p["move"]
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[0] = e[0]
        for t in range(1, steps):
            ahead[t] = _logsum(ahead[t - 1][:, :, None] + move, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            behind[t] = _logsum(move[None] + (e[t + 1] + behind[t + 1])[:, None, :], 2)
        total = _logsum(ahead[-1], 1)
        de = np.exp(ahead + behind - total[None, :, None])
        y = tags.T
        de[np.arange(steps)[:, None], np.arange(rows)[None], y] -= 1
        for t in range(1, steps):
            grad["move"] += np.exp(ahead[t - 1][:, :, None] + move + (e[t] + behind[t])[:, None, :] - total[:, None, None]).sum(axis=0)
        np.subtract.at(grad["move"], (y[:-1].ravel(), y[1:].ravel()), 1)
        de /= rows
        grad["move"] /= rows
        grad["out"], grad["bias"] = np.einsum("trh,trk->hk", h, de), de.sum(axis=(0, 1))
        dh = de @ self.p["out"].T
        dx = self._back(kf, "f", dh[:, :, :HIDDEN], grad) + self._back(kb, "b", dh[:, :, HIDDEN:], grad)
        np.add.at(grad["embed"], ids.T.ravel(), dx.reshape(-1, EMBED))
        return grad

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """The best tag sequence for scores [time, tag]; a span starts with B and goes on with I of its kind."""
        path = Path(self)
        path.add(e)
        return path.rest()


class Path:
    """Viterbi over scores that come in parts. Tags are given out once the best ways to all tags share them, so only the open end is held."""

    def __init__(self, tagger: Tagger):
        self.move, self.best, self.back = np.where(_MOVES, tagger.p["move"], -1e9), None, np.zeros((0, len(TAGS)), dtype=np.uint8)

    def add(self, e: np.ndarray) -> None:
        back = np.zeros(e.shape, dtype=np.uint8)
        for t in range(len(e)):
            if self.best is None:
                self.best = np.where(_STARTS, e[0], -1e9)
                continue
            way = self.best[:, None] + self.move
            back[t] = way.argmax(axis=0)
            self.best = way.max(axis=0) + e[t]
        self.back = np.concatenate([self.back, back])

    def _traced(self, n: int, tag: int) -> np.ndarray:
        """Tags of the first ``n`` held places, if the last of them has this one."""
        out = np.zeros(n, dtype=np.int64)
        for t in range(n - 1, -1, -1):
            out[t] = tag
            tag = self.back[t, tag]
        return out

    def settled(self) -> np.ndarray:
        """The tags that no later score can change; they are held no longer."""
        ways = np.arange(len(TAGS))
        for t in range(len(self.back) - 1, 0, -1):
            ways = self.back[t, ways]
            if (ways == ways[0]).all():
                out = self._traced(t, int(ways[0]))
                self.back = self.back[t:]
                return out
        return np.zeros(0, dtype=np.int64)

    def rest(self) -> np.ndarray:
        return self._traced(len(self.back), int(self.best.argmax())) if len(self.back) else np.zeros(0, dtype=np.int64)


_STARTS = np.array([not t.startswith("I") for t in TAGS])
_MOVES = np.array([[not b.startswith("I") or a[1:] == b[1:] and a != "O" for b in TAGS] for a in TAGS])


def regions(text: str) -> list[tuple[int, int]]:
    """The parts of a text within CONTEXT characters of a digit or @, and all of the run without white space around it."""
    out: list[list[int]] = []
    start = end = 0
    for m in TRIGGER.finditer(text):
        if m.start() >= end:
            start, after = m.start(), SPACE.search(text, m.end())
            while start and not text[start - 1].isspace():
                start -= 1
            end = after.start() if after else len(text)
        a, b = max(0, min(m.start() - CONTEXT, start)), min(len(text), max(m.end() + CONTEXT, end))
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def windows(size: int) -> list[int]:
    """Where the overlapping windows over a region of this size start."""
    return [0] if size <= WINDOW else [*range(0, size - WINDOW, STRIDE), size - WINDOW]


#: Weight of each place of a window in the average over windows.
WEIGHT = 1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])[:, None]


def averaged(tagger: Tagger, text: str, batch: int) -> Iterator[np.ndarray]:
    """Tag scores of a region, averaged over its windows; after each ``batch`` windows those that no later window meets."""
    starts, at = windows(len(text)), 0
    held = np.zeros((0, len(TAGS) + 1))  # weighted sums, then the weight
    for j in range(0, len(starts), batch):
        own = starts[j:j + batch]
        end = min(len(text), own[-1] + WINDOW)
        held = np.concatenate([held, np.zeros((end - at - len(held), len(TAGS) + 1))])
        code, ids = codes(text[own[0]:end]), np.zeros((len(own), WINDOW), dtype=np.int64)
        for r, s in enumerate(own):
            part = code[s - own[0]:s - own[0] + WINDOW]
            ids[r, :len(part)] = part
        for s, e in zip(own, tagger.scores(ids)):
            m = min(WINDOW, len(text) - s)
            held[s - at:s - at + m, :-1] += (e * WEIGHT)[:m]
            held[s - at:s - at + m, -1:] += WEIGHT[:m]
        done = starts[j + batch] - at if j + batch < len(starts) else len(held)
        yield held[:done, :-1] / held[:done, -1:]
        held, at = held[done:], at + done


def streamed_tags(tagger: Tagger, text: str, batch: int) -> Iterator[int]:
    """The best tags of a region of any length, in memory that does not grow with it."""
    path = Path(tagger)
    for e in averaged(tagger, text, batch):
        path.add(e)
        yield from path.settled().tolist()
    yield from path.rest().tolist()


def tagged_spans(tags: Iterable[int], at: int) -> Iterator[Span]:
    """The spans that tags mark, the first tag standing for place ``at``."""
    start = kind = None
    for j, tag in enumerate(itertools.chain(tags, [0]), at):
        if start is not None and (tag == 0 or TAGS[tag][0] == "B"):
            yield kind, start, j
            start = None
        if tag and TAGS[tag][0] == "B":
            start, kind = j, TAGS[tag][2:]


def decode(tagger: Tagger, texts: list[str], batch: int = 1024) -> list[list[Span]]:
    """Spans of each text, before any test of their form."""
    every = [(i, a, b) for i, t in enumerate(texts) for a, b in regions(t)]
    out: list[list[Span]] = [[] for _ in texts]
    # short regions are taken in groups, so that memory does not grow with the step; a long one is streamed
    at = 0
    while at < len(every):
        group, n = [], 0
        while at < len(every) and n < batch:
            i, a, b = every[at]
            more = len(windows(b - a))
            if more > batch:
                if group:
                    break
                out[i] += tagged_spans(streamed_tags(tagger, texts[i][a:b], batch), a)
            else:
                group.append(every[at])
                n += more
            at += 1
        ids, place = np.zeros((n, WINDOW), dtype=np.int64), []
        for g, (i, a, b) in enumerate(group):
            code = codes(texts[i][a:b])
            for s in windows(b - a):
                part = code[s:s + WINDOW]
                ids[len(place), :len(part)] = part
                place.append((g, s))
        scores = np.concatenate([tagger.scores(ids[j:j + batch]) for j in range(0, n, batch)]) if n else []
        sums = [np.zeros((b - a, len(TAGS))) for _, a, b in group]
        mass = [np.zeros((b - a, 1)) for _, a, b in group]
        for (g, s), e in zip(place, scores):
            m = min(WINDOW, len(sums[g]) - s)
            sums[g][s:s + m] += (e * WEIGHT)[:m]
            mass[g][s:s + m] += WEIGHT[:m]
        for (i, a, _), total, w in zip(group, sums, mass):
            out[i] += tagged_spans(tagger.viterbi(total / w).tolist(), a)
    return out


def fits(kind: str, s: str) -> bool:
    """Whether a span has the form of its kind."""
    digits = only_digits(s)
    if kind == "phone":
        return 10 <= len(digits) <= 15 and not set(s) - set("+().- 0123456789") and s[-1].isdigit() and len(re.findall(r"[().\x20-]+", s)) >= 2 and not IP.fullmatch(s)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and not set(s) - set(" -./0123456789") and s[0].isdigit() and s[-1].isdigit()
    if kind == "ip":
        return bool(IP.fullmatch(s)) and all(int(p[-6:]) <= 255 for p in s.split("."))
    return s.count("@") == 1 and bool(re.fullmatch(r"[^\s@]{2,}@[A-Za-z0-9.-]{3,}", s))


def added_spans(tagger: Tagger | None, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    if tagger is None:
        return [[] for _ in texts]
    out = []
    for text, known, found in zip(texts, base, decode(tagger, texts)):
        own = []
        for kind, a, b in found:
            while a < b and text[a] in " \n\t,;:.\"'":
                a += 1
            while a < b and text[b - 1] in " \n\t,;:.\"'!?":
                b -= 1
            apart = (a == 0 or not text[a - 1].isalnum()) and (b == len(text) or not text[b].isalnum())
            if a < b and apart and fits(kind, text[a:b]) and not any(x[1] < b and a < x[2] for x in known):
                own.append((kind, a, b))
        out.append(own)
    return out


# Training -----------------------------------------------------------------------------------------------
def examples(text: str, spans: list[Span]) -> list[tuple[str, list[Span]]]:
    """Windows around labelled spans, some of them rewritten, and around other triggers without a span."""
    out = []
    for kind, a, b in spans:
        if b - a > WINDOW - 8:
            continue
        room = WINDOW - (b - a)
        lead = min(a, 4 + (a * 7 + b) % (room - 4))
        s = text[a:b]
        forms = [s]
        if kind == "phone":
            forms += [s.split(" ", 1)[-1] if " " in s else s[1:], s[1:].replace(" ", "-")]
        if kind == "card":
            d = only_digits(s)
            forms.append(".".join(d[i:i + 4] for i in range(0, len(d), 4)))
        for f in forms:
            left, right = text[a - lead:a], text[b:b + room - lead]
            whole = (left + f + right)[:WINDOW]
            others = [(k, x - a + lead, y - a + lead) for k, x, y in spans if x >= a - lead and y <= a] + [(kind, lead, lead + len(f))]
            others += [(k, x - b + lead + len(f), y - b + lead + len(f)) for k, x, y in spans if x >= b and y - b + lead + len(f) <= WINDOW]
            out.append((whole, others))
    plain = []
    for a, b in regions(text):
        if not any(x < b and a < y for _, x, y in spans):
            a = max(a, TRIGGER.search(text, a).start() - CONTEXT)
            plain.append(text[a:b][:WINDOW])
    # a few from anywhere in the text
    return out + [(w, []) for w in sorted(plain, key=lambda w: (zlib.crc32(w.encode("utf-8", "replace")), w))[:COUNTER_EXAMPLES]]


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, train_windows: int = TRAIN_WINDOWS) -> Tagger | None:
    """A tagger trained on windows of about ``sample_docs`` documents, at most ``train_windows`` of them."""
    rows = docs.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    part = min(1.0, sample_docs / max(docs.count(), 1))
    if part < 1:
        rows = rows.where(hash_share("text", part))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in texts_in_steps(batches):
            found = [x for t in texts if TRIGGER.search(t) for x in examples(t, base_spans(t))]
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([joined(s) for _, s in found], pa.string())], names=["window", "spans"])

    drawn = rows.mapInArrow(run, "window string, spans string").distinct().withColumn("order", F.xxhash64("window"))
    drawn = drawn.orderBy("order", "window", "spans").limit(train_windows).collect()
    ids, tags = np.zeros((len(drawn), WINDOW), dtype=np.int64), np.zeros((len(drawn), WINDOW), dtype=np.int64)
    for r, row in enumerate(drawn):
        code = codes(row["window"])[:WINDOW]
        ids[r, :len(code)] = code
        for span in filter(None, row["spans"].split(",")):
            kind, a, b = span.split(":")
            tags[r, int(a):int(b)] = TAGS.index(f"I-{kind}")
            tags[r, int(a)] = TAGS.index(f"B-{kind}")
    if not tags.any():
        return None
    tagger = Tagger()
    tagger.train(ids, tags)
    return tagger


# Operators ----------------------------------------------------------------------------------------------
def find_pii(docs: DataFrame, tagger: Tagger | None = None, fit_here: bool = True) -> DataFrame:
    """doc_id, base counts per kind, digest of the base spans, all spans as text; the tagger is learned from ``docs`` unless given."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs) if tagger is None and fit_here else tagger)  # some 20 kB
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = StructType(list(rows.select("doc_id").schema.fields))
    for name, kind in (("n_email", "long"), ("n_ip", "long"), ("n_card", "long"), ("n_phone", "long"), ("n_added", "long"), ("base_sha256", "string"), ("spans", "string")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in_steps(batches):
            base = [base_spans(t) for t in texts]
            more = added_spans(model.value, texts, base)
            counts = [[sum(s[0] == k for s in b) for b in base] for k in KINDS] + [[len(x) for x in more]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                                              pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
                                              pa.array([joined(b + x) for b, x in zip(base, more)], pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones joined) replaced by its kind in angle brackets."""
    out, at, reach = [], 0, -1
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= reach:
            out += [text[at:a], f"<{kind.upper()}>"]
        reach = at = max(reach, b)
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with personal data masked in ``text``; ``n_chars``, if there, is the new length."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in_steps(batches):
            base = [base_spans(t) for t in texts]
            more = added_spans(model.value, texts, base)
            new = [masked(t, b + x) for t, b, x in zip(texts, base, more)]
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            null = batch.column("text").is_null().to_pylist()
            columns["text"] = pa.array([None if z else t for t, z in zip(new, null)], pa.string())
            if "n_chars" in columns:
                kind = columns["n_chars"].type
                changed = [x if old == t or z else len(t) for x, old, t, z in zip(columns["n_chars"].to_pylist(), texts, new, null)]
                columns["n_chars"] = pa.array(changed, kind)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return docs.mapInArrow(run, StructType(list(docs.schema.fields)))
