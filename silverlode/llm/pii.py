"""Personal data in texts: base patterns, and a semi-Markov conditional random field for what they miss.

Base patterns find e-mail addresses, IP addresses, card numbers and phone numbers by their exact form. They take the
longest run and give up on it when it fails, so "+1 (269) 555-3296 4524132264652876" has no base match. The random field
looks at whole candidate segments: runs of digit groups with short separators, and addresses around an at sign, plain
or spelled out. Features describe a segment as one: its shape, separators, digit count, checksum, parts, and
what stands next to it. Segments have a bounded number of groups, and dynamic programming picks the set of segments that do
not overlap with the largest total weight, so boundaries and types are chosen together; a segment is only taken for a
positive weight. Base matches stay as they are, and no added span overlaps one.

Weights come from maximum likelihood: forward sums over all sets of segments give the expected features. The labels are the
base matches in a bounded sample of documents and their rewritten forms: two put next to each other, phone numbers
without a country code, addresses with the at sign or the dots spelled out. A few made-up seeds of each kind are always in.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
ORDER = {kind: k for k, kind in enumerate(KINDS)}
Span = tuple[int, int, str]  # start, end, kind

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
# a match cannot begin inside a run of digits: it would have begun with the run
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

GROUPS = re.compile(r"[0-9]+")
JOINT = re.compile(r"[ ().+/-]{1,3}")
LONGEST_GROUPS = 8
MOST_DIGITS = 19
SPELLED_AT = re.compile(r"@|[\[({] ?at ?[\])}]", re.IGNORECASE)
LEFT_PART = re.compile(r"[A-Za-z0-9._%+-]+ ?$")
LABEL = re.compile(r" ?[A-Za-z0-9-]+")
SPELLED_DOT = re.compile(r"\.(?! )| ?[\[({] ?dot ?[\])}]", re.IGNORECASE)
LONGEST_LOCAL = 64
MOST_LABELS = 6
CONTEXT = 40


def luhn(digits: str) -> bool:
    total = 0
    for place, sign in enumerate(reversed(digits)):
        value = ord(sign) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end = 0
    for match in AT_DOMAIN.finditer(text):
        start = at = match.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            end = match.end()
            yield start, end, "email"


def base_spans(text: str) -> list[Span]:
    """Matches of the four base patterns, leftmost and not overlapping within a kind, in order."""
    found = list(_emails(text)) if "@" in text else []
    if DIGIT.search(text):
        for match in IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
                found.append((match.start(), match.end(), "ip"))
        for match in CARD.finditer(text):
            digits = re.sub(r"[ -]", "", match[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), match.end(), "card"))
        for match in PHONE.finditer(text):
            if 10 <= sum(map(str.isdecimal, match[0])) <= 15:
                found.append((match.start(), match.end(), "phone"))
    return sorted(found, key=span_order)


def span_order(span: Span) -> tuple[int, int, int]:
    return span[0], ORDER[span[2]], span[1]


# --- candidate segments and their features ---

Segment = tuple[int, int, str, tuple[str, ...]]


def _beside(text: str, at: int) -> str:
    """Class of the sign at a place: edge or space, letter, digit, or the sign itself."""
    if not 0 <= at < len(text) or text[at].isspace():
        return "space"
    sign = text[at]
    return "letter" if sign.isalpha() else "digit" if sign.isdecimal() else sign


def _number_segments(text: str) -> Iterator[Segment]:
    runs = [m.span() for m in GROUPS.finditer(text)]
    joints = [text[a[1] : b[0]] if b[0] - a[1] <= 3 else "" for a, b in zip(runs, runs[1:])]
    joined = [bool(j) and JOINT.fullmatch(j) is not None for j in joints]
    for first, (begin, _) in enumerate(runs):
        starts = [begin]
        for prefix in ("+", "(", "+("):
            if text.endswith(prefix, 0, begin):
                starts.append(begin - len(prefix))
        digits = ""
        for last in range(first, min(len(runs), first + LONGEST_GROUPS)):
            if last > first and not joined[last - 1]:
                break
            if len(digits) + runs[last][1] - runs[last][0] > MOST_DIGITS:
                break
            digits += text[slice(*runs[last])]
            if len(digits) < 4:
                continue
            end = runs[last][1]
            seps = joints[first:last]
            kinds = ["phone"] if 7 <= len(digits) <= 15 else []
            if 14 <= len(digits):
                kinds.append("card")
            if last == first + 3:
                kinds.append("ip")
            if not kinds:
                continue
            shape = "-".join(str(b - a) for a, b in runs[first : last + 1])
            marks = "".join(sorted({s for sep in seps for s in sep}))
            parts = [text[slice(*run)] for run in runs[first : last + 1]]
            for start in starts:
                prefix = text[start:begin]
                left, right = _beside(text, start - 1), _beside(text, end)
                more_left = first > 0 and joined[first - 1] and start == begin
                more_right = last < len(joined) and joined[last]
                common = [f"left {left}", f"right {right}", f"prefix {prefix}", f"more {more_left}", f"goes on {more_right}"]
                for kind in kinds:
                    own = [f"seps {marks}", *common]
                    if kind == "ip":
                        octets = all(len(p) <= 3 and int(p) <= 255 for p in parts)
                        own += [f"octets {octets} {seps == ['.'] * 3}"]
                    elif kind == "card":
                        uniform = len(set(seps)) <= 1 and all(s in (" ", "-") for s in seps)
                        own += [f"luhn {luhn(digits)}", f"groups {uniform} {min(len(parts), 6)}", f"luhn {luhn(digits)} {uniform}"]
                    else:
                        balanced = ("(" in prefix + marks) == (")" in marks)
                        own += [f"digits {len(digits)}", f"shape {shape if len(parts) < 6 else 'long'}", f"form {prefix} {marks} {len(parts)}", f"balanced {balanced}"]
                    yield start, end, kind, tuple(f"{kind} {name}" for name in ["bias", *own])


def _email_segments(text: str) -> Iterator[Segment]:
    for match in SPELLED_AT.finditer(text):
        left = LEFT_PART.search(text, max(0, match.start() - LONGEST_LOCAL - 1), match.start())
        label = LABEL.match(text, match.end())
        if not left or not label:
            continue
        at = "sign" if match[0] == "@" else "spelled"
        gap = "gap" if left[0].endswith(" ") or label[0].startswith(" ") else "tight"
        end, dots = label.end(), set()
        for labels in range(2, MOST_LABELS + 1):
            dot = SPELLED_DOT.match(text, end)
            label = dot and LABEL.match(text, dot.end())
            if not label:
                break
            dots.add("sign" if dot[0] == "." else "spelled")
            end = label.end()
            top = label[0].strip()
            more = SPELLED_DOT.match(text, end)
            goes_on = bool(more and LABEL.match(text, more.end()))
            names = [
                "bias",
                f"at {at} {gap}",
                f"dots {' '.join(sorted(dots))}",
                f"labels {labels}",
                f"top {top.isalpha() and 2 <= len(top) <= 6}",
                f"goes on {goes_on}",
                f"left {_beside(text, left.start() - 1)}",
                f"right {_beside(text, end)}",
            ]
            yield left.start(), end, "email", tuple(f"email {name}" for name in names)


def segments(text: str) -> list[Segment]:
    """All candidate segments of a text, by their ends."""
    found = list(_number_segments(text)) if DIGIT.search(text) else []
    if SPELLED_AT.search(text):
        found += _email_segments(text)
    return sorted(found, key=lambda s: (s[1], s[0], ORDER[s[2]]))


def clusters(found: list[Segment]) -> list[list[Segment]]:
    """Segments that overlap directly or by way of others, apart from all other segments."""
    out: list[list[Segment]] = []
    end = -1
    for segment in sorted(found, key=lambda s: (s[0], s[1])):
        if segment[0] >= end:
            out.append([])
        out[-1].append(segment)
        end = max(end, segment[1])
    return [sorted(own, key=lambda s: (s[1], s[0], ORDER[s[2]])) for own in out]


def best_set(found: list[Segment], weigh) -> list[Segment]:
    """The set of segments without overlap that weighs most. ``found`` is sorted by end."""
    ends = [s[1] for s in found]
    best: list[float] = [0.0]
    taken: list[int | None] = []
    for k, segment in enumerate(found):
        before = bisect_right(ends, segment[0], 0, k)
        weight = best[before] + weigh(segment)
        taken.append(before if weight > best[k] else None)
        best.append(max(best[k], weight))
    out, k = [], len(found)
    while k:
        before = taken[k - 1]
        if before is None:
            k -= 1
        else:
            out.append(found[k - 1])
            k = before
    return out[::-1]


# --- learning ---


def _log_sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def chances(befores: list[int], weights: list[float]) -> list[float]:
    """How likely each segment is in the chosen set. ``befores``: how many segments end at or before each one's start."""
    count = len(befores)
    ahead = [0.0]
    for before, weight in zip(befores, weights):
        ahead.append(_log_sum(ahead[-1], ahead[before] + weight))
    # back[k]: log of the sum of the derivatives of the total by ahead[k]
    back = [-math.inf] * count + [0.0]
    out = [0.0] * count
    for k in range(count - 1, -1, -1):
        through = back[k + 1]
        if through == -math.inf:
            continue
        back[k] = through if back[k] == -math.inf else _log_sum(back[k], through)
        by = through + weights[k]
        place = befores[k]
        back[place] = by if back[place] == -math.inf else _log_sum(back[place], by)
        out[k] = math.exp(min(0.0, ahead[place] + by - ahead[-1]))
    return out


@dataclass
class Model:
    weights: dict[str, float]

    def weigh(self, segment: Segment) -> float:
        return sum(map(self.weights.get, segment[3], [0.0] * len(segment[3])))

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        """Base spans and the spans the random field adds, in order."""
        found = segments(text)
        if base and found:
            # union of the base spans, to drop segments that touch any
            starts, ends = [], []
            for start, end, _ in sorted(base):
                if ends and start <= ends[-1]:
                    ends[-1] = max(ends[-1], end)
                else:
                    starts.append(start)
                    ends.append(end)
            found = [s for s in found if (k := bisect_right(ends, s[0])) == len(starts) or starts[k] >= s[1]]
        added = [s[:3] for s in best_set(found, self.weigh)] if found else []
        return sorted([*base, *added], key=span_order)


Example = tuple[str, list[Span]]


def learn(examples: list[Example], epochs: int = 80, rate: float = 0.5, penalty: float = 0.02) -> Model:
    """Weights of largest penalised likelihood. Like examples are counted, not repeated."""
    counted: dict[tuple, int] = defaultdict(int)
    for text, gold in examples:
        wanted = set(gold)
        for own in clusters(segments(text)):
            ends = [s[1] for s in own]
            befores = tuple(bisect_right(ends, s[0], 0, k) for k, s in enumerate(own))
            counted[befores, tuple(s[3] for s in own), tuple(s[:3] in wanted for s in own)] += 1
    names = sorted({name for _, features, _ in counted for own in features for name in own})
    number = {name: k for k, name in enumerate(names)}
    problems = []
    for (befores, features, truth), times in sorted(counted.items()):
        ids = [[number[name] for name in own] for own in features]
        flat = np.array([i for own in ids for i in own])
        owner = np.repeat(np.arange(len(ids)), [len(own) for own in ids])
        problems.append((list(befores), flat, owner, np.array(truth, dtype=float), min(50.0, times)))
    weights, power = np.zeros(len(names)), np.full(len(names), 1e-6)
    total = sum(p[4] for p in problems) or 1.0
    for _ in range(epochs):
        slope = penalty * weights
        for befores, flat, owner, truth, times in problems:
            scores = np.bincount(owner, weights[flat], minlength=len(truth)).tolist()
            error = (np.array(chances(befores, scores)) - truth) * (times / total * 100)
            np.add.at(slope, flat, error[owner])
        power += slope * slope
        weights -= rate * slope / np.sqrt(power)
    return Model({name: float(weights[k]) for name, k in number.items()})


# made-up values in forms the base patterns know; documentation ranges and test numbers
SEEDS = {
    "email": ["jane.doe@mail.example.com", "info@example.org", "a_b%c+d-1@sub.example.co"],
    "ip": ["192.0.2.17", "198.51.100.200", "203.0.113.9", "10.0.0.1"],
    "card": ["4111111111111111", "5500-0000-0000-0004", "4000 0000 0000 0002"],
    "phone": ["+1 (201) 555-0123", "+44 20 7946 0123", "+33 1 99 00 12 34", "+1-202-555-0188"],
}
PLAIN = [
    "release 4.0. of", "version 10.2.3 has", "the 3. of", "in 2019, 2020 and", "order 49928830 was", "id 4785380592391141 is",
    "on 2020-01-02 at", "at 5:30 2020-01-02 we", "20260101 120000 y", "2024-05-06 10:30:00 log", "from 12.05.2021 to 13.05.2021",
    "pages 120-135 of", "part 12-34 of 567", "about 1 000 000 000 of", "1.000.000.000 is", "pi 3.14159265 is", "1999-2003 and 2004-2008",
]


def rewritten(kind: str, value: str) -> list[str]:
    """Other forms of a value that still are personal data."""
    if kind == "phone":
        digits = re.sub(r"\D", "", value)
        tail = digits[-10:]
        if len(tail) == 10:
            area, office, line = tail[:3], tail[3:6], tail[6:]
            return [f"({area}) {office}-{line}", f"{area}-{office}-{line}", f"{area}.{office}.{line}", f"+{digits}"]
    if kind == "email":
        local, _, domain = value.partition("@")
        spelled = domain.replace(".", " [dot] ")
        return [f"{local} [at] {spelled}", f"{local}[at]{domain}", f"{local} (at) {domain}", f"{local} @ {domain}"]
    if kind == "card":
        digits = re.sub(r"\D", "", value)
        return [" ".join(digits[k : k + 4] for k in range(0, len(digits), 4)), "-".join(digits[k : k + 4] for k in range(0, len(digits), 4))]
    return []


def examples_from(snippets: list[Example]) -> list[Example]:
    """The snippets as labelled, and texts made from their values and the seeds: rewritten, and put next to each other."""
    values: dict[str, list[str]] = {kind: list(own) for kind, own in SEEDS.items()}
    for text, gold in snippets:
        for start, end, kind in gold:
            if len(values[kind]) < 60 and text[start:end] not in values[kind]:
                values[kind].append(text[start:end])
    out = list(snippets) + [(text, []) for text in PLAIN] * 10

    def make(*parts: tuple[str, str]) -> None:
        text, gold = "and", []
        for kind, value in parts:
            text += " "
            gold.append((len(text), len(text) + len(value), kind))
            text += value
        out.append((text + " then", gold))

    flat = []
    for kind in KINDS:
        for value in values[kind]:
            if base_spans(value) == [(0, len(value), kind)]:
                flat.append((kind, value))
                make((kind, value))
                for other in rewritten(kind, value):
                    make((kind, other))
    for k, first in enumerate(flat):  # each value meets a few of the others, on either side
        for step in (1, 7, 23, 41):
            make(first, flat[(k * step + step) % len(flat)])
    return out


def snippets(text: str, most: int = 200) -> list[Example]:
    """The surroundings of candidate segments with the base matches in them."""
    base = base_spans(text)
    out = []
    for own in clusters(segments(text))[:most]:
        low, high = min(s[0] for s in own), max(s[1] for s in own)
        start, end = max(0, low - CONTEXT), min(len(text), high + CONTEXT)
        inside = [(a - start, b - start, kind) for a, b, kind in base if low <= a and b <= high]
        overlap = any(x[0] < y[1] and y[0] < x[1] for k, x in enumerate(inside) for y in inside[:k])
        if not overlap:
            out.append((text[start:end], inside))
    return out


def train(docs: DataFrame, sample_rows: int = 2000) -> Model:
    """Learn from about ``sample_rows`` texts that hold a digit or an at sign, at most 200 places of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.dumps(item) for text in batch.column(0) for item in snippets(text.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["example"])

    known = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    count = known.count()
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / float(1 << 40)
    chosen = known.where(place < min(1.0, sample_rows / max(1, count))).limit(2 * sample_rows)
    rows = sorted({r.example for r in chosen.mapInArrow(run, "example string").collect()})
    return learn(examples_from([(text, [tuple(s) for s in gold]) for text, gold in map(json.loads, rows)]))


# --- on DataFrames ---


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, base matches per kind (``n_email``, ``n_ip``, ``n_card``, ``n_phone``), ``base_sha256`` and ``spans``.

    ``spans`` lists base and added spans as kind:start:end in code points, end exclusive, by start and then kind;
    ``base_sha256`` is the hash of the same list for base matches only. A null text counts as empty and has
    no span. Null ids and repeated rows are answered like any other. An empty table gives an empty result; other columns
    are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)
    names = ["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(shared.value)
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                counts = [sum(kind == own for _, _, own in base) for kind in KINDS]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                rows.append((*counts, digest, written(known.spans(text, base))))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, kinds)], names)

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of spans that overlap, replaced by the kind of its first."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


def masker(docs: DataFrame, model: Model):
    """A function from a text column to the text without personal data; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Model(shared.value)
        for texts in batches:
            yield pd.Series([text and masked(text, known.spans(text, base_spans(text))) for text in texts], dtype="object")

    return mask
