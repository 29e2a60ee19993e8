"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds what they miss.

The field scores whole candidate spans (digits, groups, check sums, characters, neighbours) and a bounded-entity
dynamic programme picks boundaries and kinds together. It is trained here, on windows of the corpus whose
spans the patterns label and on rewritten copies of them: obfuscated and short addresses, numbers without a plus sign.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Documents that windows for training are cut from, about, and windows that the field is trained on, at most.
TRAIN_DOCS = 100_000
TRAIN_WINDOWS = 700
#: Longest span in characters and tokens.
MOST_CHARS, MOST_TOKENS = 64, 26
#: Characters looked at on either side of a trigger.
MARGIN = 48
EPOCHS, RATE, SHRINK = 8, 0.5, 1e-4
HASH_PARTS = 1 << 30

# Matches equal those of the stated patterns; the guards only keep long runs linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"@|[\[(]\x20?at\x20?[\])]", re.IGNORECASE)
_DOT = r"(?:\.|\x20?[\[(]\x20?(?:\.|dot)\x20?[\])]\x20?)"
_TRIGGER = re.compile(
    r"@|[\[(]\x20?at\x20?[\])]|[0-9](?:[\x20().\[\]-]{0,3}+[0-9]){6,}+|[0-9]{1,3}(?:" + _DOT + "[0-9]{1,3}){3}", re.IGNORECASE
)
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|.", re.DOTALL)
_MAIL = re.compile(r"[\w.%+-]+\s?(?:@|[\[(]\s?at\s?[\])])\s?[\w-]+(?:\s?(?:\.|[\[(]\s?dot\s?[\])])\s?[\w-]+)+", re.IGNORECASE)


def digits_of(text: str) -> str:
    return "".join(re.findall("[0-9]", text))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = int(c) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def octets(text: str) -> bool:
    """Whether all numbers are at most 255; leading zeros don't count."""
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in re.findall("[0-9]+", text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = at = found.end()
        else:
            at += 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind as listed, then start."""
    spans = [("email", a, b) for a, b in _emails(text)]
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if octets(m[0])]
    spans += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return spans


def windows(text: str) -> list[tuple[int, int]]:
    """Parts of the text about triggers; those that touch are one."""
    parts: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        low, high = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if parts and low <= parts[-1][1]:
            parts[-1][1] = high
        else:
            parts.append([low, high])
    return [(a, b) for a, b in parts]


def _kind_of(char: str) -> str:
    return "9" if "0" <= char <= "9" else "a" if char.isalpha() else "_" if char.isspace() else char


def features(text: str, a: int, b: int) -> list[str]:
    """Names of the features of a whole span and its two neighbours."""
    span = text[a:b]
    digits = digits_of(span)
    groups = "-".join(str(min(len(g), 9)) for g in re.findall("[0-9]+", span)[:7])
    used = "".join(sorted(set(map(_kind_of, span))))[:8]
    left = _kind_of(text[a - 1]) if a else "^"
    right = _kind_of(text[b]) if b < len(text) else "$"
    ats, count = len(_AT.findall(span)), min(len(digits), 20)
    names = [
        "bias", f"digits{count}", f"groups{groups}", f"used{used}", f"ats{min(ats, 2)}", f"left{left}", f"right{right}",
        f"first{_kind_of(span[0])}", f"last{_kind_of(span[-1])}", f"edge{left}{_kind_of(span[0])}", f"edge{_kind_of(span[-1])}{right}",
        f"closed{span.count('(') == span.count(')') and span.count('[') == span.count(']')}",
    ]
    if ats == 1:
        names.append(f"mail{bool(_MAIL.fullmatch(span))}")
    else:
        names.append(f"number{count}{not any(map(str.isalpha, span))}")
    if 13 <= count <= 19:
        names.append(f"sum{count}{luhn(digits)}")
    if groups.count("-") == 3 and max(map(int, groups.split("-"))) <= 3:
        names.append(f"octets{octets(span)}{'.' in span}")
    return names


class Lattice(NamedTuple):
    """Token bounds of a window, and its candidate spans as (first token, end token) with their features."""

    bounds: list[int]
    spans: list[tuple[int, int]]
    names: list[list[str]]


def lattice(text: str) -> Lattice:
    bounds = [m.start() for m in _TOKEN.finditer(text)] + [len(text)]
    spans, names = [], []
    for i, a in enumerate(bounds[:-1]):
        if text[a].isspace():
            continue
        for j in range(i + 1, min(i + MOST_TOKENS, len(bounds) - 1) + 1):
            b = bounds[j]
            if b - a > MOST_CHARS:
                break
            span = text[a:b]
            if not span[-1].isspace() and (len(digits_of(span)) >= 4 or _AT.search(span)):
                spans.append((i, j))
                names.append(features(text, a, b))
    return Lattice(bounds, spans, names)


class Field(NamedTuple):
    """Weights per feature and kind. A token outside any entity scores 0."""

    weights: dict[str, list[float]]

    def scores(self, names: list[str]) -> list[float]:
        total = [0.0] * len(KINDS)
        for name in names:
            for k, w in enumerate(self.weights.get(name, ())):
                total[k] += w
        return total

    def decode(self, text: str) -> list[tuple[str, int, int]]:
        """The best segmentation of a window: its entities as (kind, start, end)."""
        if not self.weights:
            return []
        grid = lattice(text)
        ending: dict[int, list[tuple[int, list[str]]]] = {}
        for (i, j), names in zip(grid.spans, grid.names):
            ending.setdefault(j, []).append((i, names))
        best, back = [0.0], [None]
        for j in range(1, len(grid.bounds)):
            top, how = best[j - 1], None
            for i, names in ending.get(j, ()):
                scores = self.scores(names)
                k = max(range(len(KINDS)), key=scores.__getitem__)
                if best[i] + scores[k] > top:
                    top, how = best[i] + scores[k], (i, k)
            best.append(top)
            back.append(how)
        found, j = [], len(grid.bounds) - 1
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, k = back[j]
                found.append((KINDS[k], grid.bounds[i], grid.bounds[j]))
                j = i
        return found[::-1]


def rewritten(text: str, spans: list[tuple[str, int, int]], turn: int) -> tuple[str, list[tuple[str, int, int]]]:
    """The window with its entities in another spelling, as people write them to evade patterns."""
    out, made, done = "", [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < done:
            continue
        span = text[a:b]
        if kind == "email":
            name, site = span.rsplit("@", 1)
            at = (" [at] ", " (at) ", "[at]", "(at)")[turn % 4]
            span = name + at + (site if turn % 3 else site.replace(".", " [dot] " if turn % 2 else "[dot]"))
        elif kind == "phone":
            span = span[1:] if turn % 2 else re.sub(r"^\+[0-9]{1,3}[\x20.-]+", "", span) or span
        elif kind == "ip":
            span = span.replace(".", ("[.]", "[.]", "(.)", "[dot]")[turn % 4])
        else:
            span = " - ".join(re.findall(".{1,4}", digits_of(span))) if turn % 2 else ".".join(re.findall(".{1,4}", digits_of(span)))
        out += text[done:a]
        made.append((kind, len(out), len(out) + len(span)))
        out += span
        done = b
    return out + text[done:], made


def shortened(text: str, spans: list[tuple[str, int, int]], turn: int) -> tuple[str, list[tuple[str, int, int]]]:
    """The window with the last digit in place of some numbers of its ips, all of them in every 16th turn."""
    out, made, done = "", [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        span = text[a:b]
        if kind == "ip":
            span = ".".join(p if turn >> k & 1 else p[-1] for k, p in enumerate(span.split(".")))
        out += text[done:a]
        made.append((kind, len(out), len(out) + len(span)))
        out += span
        done = b
    return out + text[done:], made


def train(samples: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = EPOCHS) -> Field:
    """Weights by gradient steps on the conditional likelihood of each window's segmentation."""
    import numpy as np

    index: dict[str, int] = {}
    ready = []
    for text, gold in samples:
        grid = lattice(text)
        place = {c: t for t, c in enumerate(grid.bounds)}
        at = {span: s for s, span in enumerate(grid.spans)}
        wanted = {}
        for kind, a, b in gold:
            s = at.get((place.get(a), place.get(b)))
            if s is not None:
                wanted[s] = KINDS.index(kind)
        if len(wanted) < len(gold):
            continue
        names = [np.array([index.setdefault(n, len(index)) for n in row]) for row in grid.names]
        ready.append((len(grid.bounds), grid.spans, names, wanted))
    weights, squares = np.zeros((len(index), len(KINDS))), np.full((len(index), len(KINDS)), 1e-6)
    order = np.random.default_rng(11)
    for _ in range(epochs):
        for r in order.permutation(len(ready)):
            size, spans, names, wanted = ready[r]
            if not spans:
                continue
            scores = np.array([weights[ids].sum(0) for ids in names])
            merged = np.logaddexp.reduce(scores, 1)
            ends, starts = {}, {}
            for s, (i, j) in enumerate(spans):
                ends.setdefault(j, []).append((i, s))
                starts.setdefault(i, []).append((j, s))
            ahead, behind = np.zeros(size), np.zeros(size)
            for j in range(1, size):
                ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[i] + merged[s] for i, s in ends.get(j, ()))])
            for i in range(size - 2, -1, -1):
                behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[j] + merged[s] for j, s in starts.get(i, ()))])
            outside = np.array([ahead[i] + behind[j] for i, j in spans]) - ahead[-1]
            step = -np.exp(np.minimum(scores + outside[:, None], 0.0))
            for s, k in wanted.items():
                step[s, k] += 1.0
            for s in np.flatnonzero(np.abs(step).max(1) > 1e-3):
                ids = names[s]
                slope = step[s] - SHRINK * weights[ids]
                squares[ids] += slope**2
                weights[ids] += RATE * slope / np.sqrt(squares[ids])
    return Field({n: weights[k].tolist() for n, k in index.items()})


def fit(docs: DataFrame, train_windows: int = TRAIN_WINDOWS, train_docs: int = TRAIN_DOCS, text_col: str = "text") -> Field:
    """A field from at most ``train_windows`` different windows: those with the smallest hashes in about ``train_docs`` whole texts,
    which a hash of the text chooses. Both bounds hold what meets at the driver, however many tasks there are.
    """
    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            parts = [t[a:b] for cell in batch.column(0) if (t := cell.as_py()) for a, b in windows(t) if b - a <= 8 * MARGIN]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string())], names=["part"])

    texts = docs.select(F.col(text_col).alias("text"))
    share = int(min(1.0, train_docs / max(texts.count(), 1)) * HASH_PARTS)
    parts = texts.where(F.pmod(F.xxhash64("text"), F.lit(HASH_PARTS)) < share).mapInArrow(cut, "part string").distinct()
    chosen = [r.part for r in parts.orderBy(F.xxhash64("part"), "part").limit(train_windows).collect()]
    samples = []
    for turn, text in enumerate(chosen):
        spans = base_spans(text)
        if any(a < d and c < b for k, (_, a, b) in enumerate(spans) for _, c, d in spans[:k]):
            continue
        samples.append((text, spans))
        if spans:
            samples.append(rewritten(text, spans, turn))
        if any(kind == "ip" for kind, *_ in spans):
            # Another stretch of turns per short form, so that each meets each spelling.
            samples.append(rewritten(*shortened(text, spans, turn // 4), turn))
    return train(samples) if any(gold for _, gold in samples) else Field({})


def find(text: str | None, field: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans): the field adds those of its spans that touch no base span."""
    text = text or ""
    base, more = base_spans(text), []
    held = sorted((a, b) for _, a, b in base)
    for low, high in windows(text):
        inside = [(a, b) for a, b in held if a < high and b > low] if held else []
        for kind, a, b in field.decode(text[low:high]):
            a, b = a + low, b + low
            if not any(a < d and c < b for c, d in inside):
                more.append((kind, a, b))
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + more, key=lambda s: (order[s[0]], s[1], s[2]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_<kind> of the patterns, base_sha256 and spans of every row, from its whole text.

    Places are code points, ends exclusive. Null and empty texts have no spans; null ids and repeated rows keep their
    place; other columns are not read; an empty table gives no rows.
    """
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def mapped(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for cell in batch.column(1):
                base, every = find(cell.as_py(), field)
                kinds = [s[0] for s in base]
                rows.append((*map(kinds.count, KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string"
    return rows.mapInArrow(mapped, schema)
