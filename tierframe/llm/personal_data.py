"""Personal data in texts: fixed patterns, and a semi-Markov random field that adds to them.

The patterns take the longest match and drop it whole if it fails its test, so a
phone number with an address behind it is lost.  The field cuts the characters
around digits and ``@`` into segments instead: every segment that passes the test
of a kind is scored as a whole for it, and a dynamic programme picks the segments
and their kinds together.  It also finds secrets, such as keys of an interface, which
no pattern looks for: runs of changing letters and digits.  It is trained on the finds of
the patterns in a bounded sample of the corpus, and for secrets on the runs in it that
stand where a name such as ``token`` is given a value.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# found by the field alone; comes after the others
SECRET = "secret"
ORDER = {kind: n for n, kind in enumerate((*KINDS, SECRET))}
# The patterns.  The look-behinds do not change the matches; they
# keep runs of letters or digits from being tried at each of their characters.
LOCAL = "A-Za-z0-9._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, str]

# windows that the field is fitted on, at most, and documents they come from
WINDOWS = 1200
SAMPLE = 4000
# characters of a window that the field is fitted on, at most; longer ones are decoded
# like all others
LONGEST_WINDOW = 200
# bound of the entities of the field, in atoms (runs of letters, runs of digits, single
# characters); the patterns, and secrets, which are whole runs, have none
MOST_ATOMS = 28
EPOCHS = 12
RATE = 0.3
DECAY = 1e-4

SEED = re.compile("[0-9@]")
WINDOW = re.compile(r"[^\s0-9@]*[0-9@]\S*(?:\x20[^\s0-9@]*[0-9@]\S*)*")
ATOM = re.compile(r"[0-9]+|[A-Za-z]+|.", re.DOTALL)
DIGITS = re.compile("[0-9]+")
RUN = re.compile(r"[A-Za-z0-9_-]+")
# a letter that follows a digit or the reverse: a secret has LEAST_CHANGES of them
CHANGE = re.compile(r"(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]")
LEAST_CHANGES = 4
LEAST_SECRET = 16
HEX = re.compile("[0-9A-Fa-f]+")
# Names whose value is taken for a secret in training
ASSIGNED = re.compile(
    r"(?:key|token|secret|password|passwd|pwd)[\"']?\s*[:=]\s*[\"']?([A-Za-z0-9_-]+)", re.IGNORECASE
)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def _is_ip(text: str) -> bool:
    # a part of many digits with a small value needs leading zeros
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def emails(text: str) -> list[Span]:
    """Matches of the address pattern, found from the ``@``."""
    out: list[Span] = []
    end = 0
    for found in DOMAIN.finditer(text):
        start = at = found.start()
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at:
            out.append((start, found.end(), "email"))
            end = found.end()
    return out


def base_spans(text: str) -> list[Span]:
    """Finds of the patterns by start, then kind; those that fail their test are dropped."""
    if not SEED.search(text):
        return []
    out = emails(text) if "@" in text else []
    for kind, pattern, test in (("ip", IP, _is_ip), ("card", CARD, _is_card), ("phone", PHONE, _is_phone)):
        out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if test(m[0])]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


EMAIL_SHAPE = re.compile(rf"[{LOCAL}]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP_SHAPE = re.compile(r"[0-9]+(\.[0-9]+){3}")


def _is_secret(text: str) -> bool:
    return len(text) >= LEAST_SECRET and len(CHANGE.findall(text)) >= LEAST_CHANGES


def named_secrets(text: str) -> list[Span]:
    """Values of names such as ``token`` that look like a secret."""
    return [(*m.span(1), SECRET) for m in ASSIGNED.finditer(text) if _is_secret(m[1])]


def _valid(kind: str, text: str) -> bool:
    if kind == "email":
        return bool(EMAIL_SHAPE.fullmatch(text))
    if kind == "ip":
        return bool(IP_SHAPE.fullmatch(text)) and _is_ip(text)
    if kind == "card":
        return bool(CARD.fullmatch(text)) and _is_card(text)
    return bool(PHONE.fullmatch(text)) and _is_phone(text)


def _class(char: str) -> str:
    # windows end at white space, so an end is one
    if not char or char.isspace():
        return "space"
    if char.isdigit():
        return "digit"
    return "letter" if char.isalpha() else char


def _segment_features(kind: str, text: str, left: str, right: str) -> list[str]:
    groups = [len(g) for g in DIGITS.findall(text)]
    count = sum(groups)
    made = [
        "any",
        f"left={_class(left)}",
        f"right={_class(right)}",
        f"first={_class(text[0])}",
    ]
    if kind == "email":
        host = text.partition("@")[2]
        made += [f"ats={min(text.count('@'), 2)}", f"dots={min(host.count('.'), 4)}"]
    elif kind == SECRET:
        cases = "one" if text in (text.lower(), text.upper()) else "both"
        changes = min(8 * len(CHANGE.findall(text)) // len(text), 6)
        made += [
            f"length={min(len(text) // 8, 8)}",
            f"hex={bool(HEX.fullmatch(text))}",
            f"cases={cases}",
            f"changes={changes}",
        ]
    else:
        shape = "-".join(map(str, groups)) if len(groups) <= 6 else "many"
        signs = "".join(sorted({c for c in text if not c.isdigit()}))
        made += [f"digits={min(count, 24)}", f"shape={shape}", f"signs={signs}"]
    return [f"{kind}|{m}" for m in made]


def _atom_feature(text: str) -> str:
    if text[0].isdigit():
        return f"out|digits={min(len(text), 24)}"
    return "out|letters" if text[0].isalpha() else f"out|{text}" if text in "@+.-() " else "out|sign"


class Lattice:
    """Atoms of a window and every segment that passes the test of a kind."""

    def __init__(self, text: str):
        bounds = [m.span() for m in ATOM.finditer(text)]
        self.bounds = bounds
        self.outside = [_atom_feature(text[a:b]) for a, b in bounds]
        # by first atom: (atom after the last, kind, features)
        self.segments: list[list[tuple[int, str, list[str]]]] = []
        # a secret is a whole run, so it begins and ends with atoms, however many
        runs = {m.start(): m.end() for m in RUN.finditer(text) if _is_secret(m[0])}
        after = {b: j + 1 for j, (_, b) in enumerate(bounds)} if runs else {}
        for i, (start, _) in enumerate(bounds):
            here: list[tuple[int, str, list[str]]] = []
            self.segments.append(here)
            if start in runs:
                b = runs[start]
                left, right = text[start - 1 : start], text[b : b + 1]
                made = _segment_features(SECRET, text[start:b], left, right)
                here.append((after[b], SECRET, made))
            if not (text[start].isascii() and (text[start].isalnum() or text[start] in "+(._%-")):
                continue
            ats = letters = digits = blanks = 0
            for j in range(i, min(i + MOST_ATOMS, len(bounds))):
                a, b = bounds[j]
                part = text[a:b]
                ats += part == "@"
                letters += part[0].isalpha() or part[0] in "_%"
                digits += part[0] in "0123456789"
                blanks += part in (" ", "(", ")")
                if not (part[0].isascii() and (part[0].isalnum() or part in "+(). -_%@")):
                    break
                if ats > 1 or (blanks and (ats or letters)):
                    break
                if not (part[0].isascii() and part[0].isalnum()):
                    continue
                kinds = ("email",) if ats else KINDS[1:] if digits and not letters else ()
                whole = text[start:b]
                left, right = text[start - 1 : start], text[b : b + 1]
                for kind in filter(lambda k: _valid(k, whole), kinds):
                    here.append((j + 1, kind, _segment_features(kind, whole, left, right)))


class SpanModel:
    """Weights of the features; the score of a cut is the sum over its segments.

    Only ``kinds``, those that the training had, are found.
    """

    def __init__(self, weights: dict[str, float], kinds: frozenset[str]):
        self.weights = weights
        self.kinds = kinds

    def _score(self, features: list[str]) -> float:
        return sum(self.weights.get(f, 0.0) for f in features)

    def decode(self, text: str) -> list[Span]:
        """The best segments of a window; time grows with its length times MOST_ATOMS."""
        lattice = Lattice(text)
        n = len(lattice.bounds)
        best = [-math.inf] * (n + 1)
        best[0] = 0.0
        came: list[tuple[int, str | None]] = [(0, None)] * (n + 1)
        for i in range(n):
            out = best[i] + self._score([lattice.outside[i]])
            # an empty field leaves everything outside
            if out >= best[i + 1]:
                best[i + 1], came[i + 1] = out, (i, None)
            for j, kind, features in lattice.segments[i]:
                if kind not in self.kinds:
                    continue
                score = best[i] + self._score(features)
                if score > best[j]:
                    best[j], came[j] = score, (i, kind)
        spans: list[Span] = []
        at = n
        while at:
            before, kind = came[at]
            if kind:
                spans.append((lattice.bounds[before][0], lattice.bounds[at - 1][1], kind))
            at = before
        return spans[::-1]

    def spans(self, text: str) -> list[Span]:
        """Segments of a whole text, by start."""
        return [
            (m.start() + a, m.start() + b, kind)
            for m in WINDOW.finditer(text)
            for a, b, kind in self.decode(m[0])
        ]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def fit(windows: list[tuple[str, list[Span]]]) -> SpanModel:
    """Maximum likelihood of the given spans, by stochastic gradient steps.

    Spans that are no segment of the lattice or overlap an earlier one are left
    out of the truth.
    """
    examples = []
    for text, spans in windows:
        lattice = Lattice(text)
        starts = {a: i for i, (a, _) in enumerate(lattice.bounds)}
        ends = {b: i + 1 for i, (_, b) in enumerate(lattice.bounds)}
        truth: set[tuple[int, int, str]] = set()
        reached = 0
        for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
            i, j = starts.get(a, -1), ends.get(b, -1)
            if i >= reached and any((j, kind) == s[:2] for s in lattice.segments[i]):
                truth.add((i, j, kind))
                reached = j
        examples.append((lattice, truth))
    weights: dict[str, float] = {}
    squares: dict[str, float] = {}
    for _ in range(EPOCHS):
        for lattice, truth in examples:
            n = len(lattice.bounds)
            edges = [
                (i, j, kind, features)
                for i in range(n)
                for j, kind, features in [(i + 1, "", [lattice.outside[i]]), *lattice.segments[i]]
            ]
            scores = [sum(weights.get(f, 0.0) for f in e[3]) for e in edges]
            into: list[list[int]] = [[] for _ in range(n + 1)]
            outof: list[list[int]] = [[] for _ in range(n + 1)]
            for e, (i, j, _, _) in enumerate(edges):
                into[j].append(e)
                outof[i].append(e)
            ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
            for j in range(1, n + 1):
                ahead[j] = _log_sum([ahead[edges[e][0]] + scores[e] for e in into[j]])
            for i in range(n - 1, -1, -1):
                behind[i] = _log_sum([behind[edges[e][1]] + scores[e] for e in outof[i]])
            covered = {at for i, j, _ in truth for at in range(i, j)}
            slope: dict[str, float] = {}
            for e, (i, j, kind, features) in enumerate(edges):
                wanted = (i, j, kind) in truth if kind else i not in covered
                pull = wanted - math.exp(ahead[i] + scores[e] + behind[j] - ahead[n])
                if abs(pull) > 1e-6:
                    for f in features:
                        slope[f] = slope.get(f, 0.0) + pull
            for f, g in slope.items():
                g -= DECAY * weights.get(f, 0.0)
                squares[f] = squares.get(f, 0.0) + g * g
                weights[f] = weights.get(f, 0.0) + RATE * g / math.sqrt(squares[f] + 1e-8)
    return SpanModel(weights, frozenset(kind for _, truth in examples for _, _, kind in truth))


def train(
    docs: DataFrame,
    text_col: str = "text",
    sample: int = SAMPLE,
    windows: int = WINDOWS,
    longest: int = LONGEST_WINDOW,
) -> SpanModel:
    """Fit on at most ``windows`` windows, of up to ``longest`` characters, of the
    ``sample`` different texts of the smallest hash.

    Only texts with a digit or ``@`` count.  The finds of the patterns and the secrets
    that are given to a name are the truth; what the patterns dropped in a window that
    looks like a find put together with something else is judged by the weights of
    whole segments.  The windows are what comes to the driver; an empty corpus gives
    a field that adds nothing, and one without named secrets a field that finds none.
    """
    seeded = docs.select(F.col(text_col).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    # by hash, so that the sample is the same in every run and copies count once
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    share = min(1.0, sample / max(seeded.select(place).distinct().count(), 1))
    seeded = seeded.filter(place < int(share * (1 << 40)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[str] = []
            named: list[list[int]] = []
            for text in batch.column("text").to_pylist():
                secrets = named_secrets(text)
                starts = [a for a, _, _ in secrets]
                for m in WINDOW.finditer(text):
                    here = secrets[bisect_left(starts, m.start()) : bisect_left(starts, m.end())]
                    found.append(m[0])
                    named.append([at - m.start() for a, b, _ in here for at in (a, b)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array(named, pa.list_(pa.int32()))], ["window", "named"]
            )

    rows = (
        seeded.mapInArrow(cut, "window string, named array<int>")
        .filter(F.length("window") <= longest)
        .distinct()
        .orderBy(F.xxhash64("window"), "window", "named")
        .limit(windows)
        .collect()
    )
    return fit(
        [
            (r.window, base_spans(r.window) + [(a, b, SECRET) for a, b in zip(r.named[::2], r.named[1::2])])
            for r in rows
        ]
    )


def find_spans(text: str, model: SpanModel) -> tuple[list[Span], list[Span]]:
    """Finds of the patterns, and all spans: those and what the field adds beside them."""
    base = base_spans(text)
    if not SEED.search(text):
        return base, base
    merged: list[tuple[int, int]] = []
    for a, b, _ in base:
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    added, at = [], 0
    for span in model.spans(text):
        while at < len(merged) and merged[at][1] <= span[0]:
            at += 1
        if at == len(merged) or merged[at][0] >= span[1]:
            added.append(span)
    every = sorted(base + added, key=lambda s: (s[0], ORDER[s[2]]))
    return base, every


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def detect(
    docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Spans of personal data in each whole text.

    Returns one row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone
    (finds of the patterns), base_sha256 (of the finds as kind:start:end, joined
    by commas), spans (finds and additions, joined alike; secrets are additions) and
    n_spans, their number.  Offsets count code points, the end is exclusive.  An addition never overlaps a find.  A null
    text is empty and has none.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )

    def detected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t, model) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[
                        pa.array([sum(s[2] == kind for s in base) for base, _ in found], pa.int64())
                        for kind in KINDS
                    ],
                    pa.array([hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in found]),
                    pa.array([_listed(every) for _, every in found], pa.string()),
                    pa.array([len(every) for _, every in found], pa.int64()),
                ],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_spans"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(detected, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_spans long")
