"""Personal data by a semi-Markov conditional random field over candidate spans.

1. One pass over all texts finds the base spans (fixed patterns) and the stretches that can
   hold an entity at all: runs of digits with separators, and what stands around an at
   sign in any of its spellings. Between stretches no segment can lie, so the field over a
   whole text is the product of the fields over its stretches, and only these go on.
2. The field is trained on a bounded sample of stretches. Their base spans are the labels;
   each stretch is also shown in another spelling of its entity (a phone number without
   its plus, an address written with "(at)") and with a number that is none (dates,
   lists, numbers that fail their checksum).
3. A segment is any span of whole tokens up to ``MOST_TOKENS`` of them; its score is the
   weights of features of the whole span (digits, grouping, separators, checksum, borders,
   words in front) for one kind. Dynamic programming over the ends of segments picks
   boundaries and kinds together. Base spans are given: segments that cross one are left
   out, and its own is taken.
4. A segment of the best segmentation is added if its marginal probability is at least
   ``CONFIDENT``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from curbair.llm.common import slices
from curbair.sources.staging import staged

KINDS = ("email", "ip", "card", "phone")
#: Stretches of the training sample, passes over it, and strength of the penalty.
SAMPLE, EPOCHS, PENALTY = 600, 12, 1e-3
#: Tokens of the longest segment, and the least marginal of an added span.
MOST_TOKENS, CONFIDENT = 24, 0.9
#: Groups of digits of the longest number, and characters after which a stretch is cut
#: before the next character that is no digit (segments do not reach over the cut).
MOST_GROUPS, STRETCH_CHARS = 8, 2000
#: Characters around a stretch that features may look at.
CONTEXT = 40
TEXT_BYTES = 1 << 20

# patterns and limits of the base kinds: fixed values
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, IP_MOST = (16, 19), (8, 15), 255

_MAY_HOLD = r"[0-9]|@|[(\[{]at[)\]}]"
_NUMERIC = re.compile(r"[(+]?[0-9](?:[ ().:/\[\]-]{0,3}[0-9]){6,}")
_QUAD = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}")
_AT = re.compile(r"@|[(\[{]at[)\]}]")
_AROUND_AT = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:@|[(\[{]at[)\]}]) ?[A-Za-z0-9.-]{1,64}")
_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|.", re.DOTALL)
_DIGITS, _NO_DIGIT = re.compile(r"[0-9]+"), re.compile(r"[^0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Whether the checksum of a card number holds."""
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(twice) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _at_most(number: str, most: int) -> bool:
    number = number.lstrip("0")
    return len(number) <= len(str(most)) and int(number or 0) <= most


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses from left to right: at each at sign the longest local part that does not
    reach into the one before, in time linear in the text."""
    taken, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            taken = domain.end()
            yield start, taken
        at = text.find("@", max(at + 1, taken))


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns in code points, by kind and then by start."""
    out: list[Span] = [("email", *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        if all(_at_most(part, IP_MOST) for part in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if PHONE_DIGITS[0] <= sum(map(len, _DIGITS.findall(m.group()))) <= PHONE_DIGITS[1]:
            out.append(("phone", *m.span()))
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """Where entities can lie, from left to right; none overlap."""
    found = [m.span() for pattern in (_NUMERIC, _QUAD) for m in pattern.finditer(text)]
    if _AT.search(text):
        found += [m.span() for m in _AROUND_AT.finditer(text)]
    out: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return [part for start, end in out for part in _cut(text, start, end)]


def _cut(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    while end - start > STRETCH_CHARS:
        stop = _NO_DIGIT.search(text, start + STRETCH_CHARS, end)
        if not stop:
            break
        yield start, stop.start()
        start = stop.start()
    yield start, end


# features of a whole span

#: Words in front of a span that tell of a kind, or of none.
_HINTS = {
    "phone": "phone", "tel": "phone", "call": "phone", "mobile": "phone", "fax": "phone", "dial": "phone",
    "mail": "email", "email": "email", "contact": "email", "write": "email",
    "ip": "ip", "host": "ip", "server": "ip", "address": "ip",
    "card": "card", "visa": "card", "credit": "card", "payment": "card",
    "date": "other", "order": "other", "isbn": "other", "version": "other", "page": "other", "id": "other", "no": "other",
}
_NAMES = [
    "bias", *[f"digits{n}" for n in (0, 7, 8, 10, 11, 12, 13, 16, 17, 20)], *[f"groups{n}" for n in range(7)],
    *[f"has{c}" for c in " -.(/:["], "mixed", "plus", "paren", *[f"first{n}" for n in range(1, 6)],
    *[f"last{n}" for n in range(1, 6)], "fours", "quad", "bytes", "luhn", "at", "spelled", "dotted", "top", "letters",
    "glued_left", "glued_right", "more_left", "more_right", "joined_left",
    "joined_right", "date", "year", "one_digit_groups", "unbalanced",
    *[f"hint_{h}" for h in ("phone", "email", "ip", "card", "other")]]
_FEATURE = {name: i for i, name in enumerate(_NAMES)}
_DATE = re.compile(r"(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4})(?:[ T]|$)")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+( ?(?:@|[(\[{]at[)\]}]) ?)([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)")
_ALLOWED = frozenset("0123456789 ().:/-[]+")


def _features(window: str, start: int, end: int, hint: str | None) -> list[int] | None:
    """Indices of the features of one span, or None if it cannot be an entity."""
    span = window[start:end]
    at = _AT.search(span)
    names = ["bias"]
    if at:
        whole = _ADDRESS.fullmatch(span)
        if not whole:
            return None
        names.append("at" if whole[1] == "@" else "spelled")
        parts = whole[2].split(".")
        if len(parts) > 1:
            names.append("dotted")
        if parts[-1].isalpha() and 2 <= len(parts[-1]) <= 12 and len(parts) > 1:
            names.append("top")
        if span[0].isalpha() or span[0].isdigit():
            names.append("letters")
    elif not _ALLOWED.issuperset(span):
        return None
    else:
        groups = _DIGITS.findall(span)
        digits = "".join(groups)
        marks = {c for c in span if not c.isdigit()}
        quad = len(groups) == 4 and all(len(g) <= 3 for g in groups) and marks in ({"."}, {"[", ".", "]"})
        if len(digits) < 7 and not quad:
            return None
        names.append(f"digits{max(n for n in (0, 7, 8, 10, 11, 12, 13, 16, 17, 20) if n <= len(digits))}")
        names.append(f"groups{min(len(groups), 6)}")
        names += [f"has{c}" for c in " -.(/:[" if c in marks]
        if len(marks - {"(", ")", "+"}) > 1:
            names.append("mixed")
        if span[0] in "+(":
            names.append("plus" if span[0] == "+" else "paren")
        names += [f"first{min(len(groups[0]), 5)}", f"last{min(len(groups[-1]), 5)}"]
        if len(groups) > 1 and all(len(g) == 4 for g in groups):
            names.append("fours")
        if quad:
            names.append("quad")
            if all(int(g) <= IP_MOST for g in groups):
                names.append("bytes")
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            names.append("luhn")
        if _DATE.match(span):
            names.append("date")
        if len(groups[0]) == 4 and groups[0][:2] in ("19", "20"):
            names.append("year")
        if len(groups) > 3 and all(len(g) <= 2 for g in groups):
            names.append("one_digit_groups")
        if span.count("(") != span.count(")") or span.count("[") != span.count("]"):
            names.append("unbalanced")
    left, right = window[start - 1 : start], window[end : end + 1]
    if left.isalnum() or left in ("_", "+", "("):
        names.append("glued_left")
    if right.isalnum() or right == "_":
        names.append("glued_right")
    if left and left in "._%+-":
        names.append("joined_left")
    if re.match(r"[._%+-][A-Za-z0-9]", window[end : end + 2]):
        names.append("joined_right")
    if re.search(r"[0-9][ ().:/\[\]-]{0,3}$", window[max(0, start - 4) : start]):
        names.append("more_left")
    if re.match(r"[ ().:/\[\]-]{0,3}[0-9]", window[end : end + 4]):
        names.append("more_right")
    if hint:
        names.append(f"hint_{hint}")
    return [_FEATURE[n] for n in names]


def _hint_before(window: str, start: int) -> str | None:
    for word in reversed(re.findall(r"[A-Za-z]+", window[max(0, start - CONTEXT) : start])[-3:]):
        if word.lower() in _HINTS:
            return _HINTS[word.lower()]
    return None


class Lattice:
    """Candidate segments of one stretch: ends in tokens, and features of each span.

    ``given`` are the base spans, in the window's code points.
    """

    def __init__(self, window: str, low: int, high: int, given: list[Span]):
        tokens = [m.span() for m in _TOKEN.finditer(window, low, high)]
        self.tokens = tokens
        self.count = len(tokens)
        begins, ends = {s: i for i, (s, _) in enumerate(tokens)}, {e: i + 1 for i, (_, e) in enumerate(tokens)}
        self.given = {(begins[s], ends[e]): KINDS.index(k) for k, s, e in given if s in begins and e in ends}
        hint = _hint_before(window, low)
        self.spans: list[tuple[int, int]] = []
        rows: list[list[int]] = []
        mail = _AT.search(window, low, high)
        for i, (start, _) in enumerate(tokens):
            if not (window[start].isalnum() or window[start] in "+("):
                continue
            groups = 0
            for j in range(i + 1, min(self.count, i + MOST_TOKENS) + 1):
                end = tokens[j - 1][1]
                groups += window[end - 1].isdigit()
                if groups > MOST_GROUPS and not mail:
                    break
                if not window[end - 1].isalnum() or any(
                        s < end and start < e and (s, e) != (start, end) for _, s, e in given):
                    continue
                found = _features(window, start, end, hint)
                if found is not None:
                    self.spans.append((i, j))
                    rows.append(found)
        self.x = np.zeros((len(rows), len(_NAMES)), np.float32)
        for row, found in zip(self.x, rows, strict=True):
            row[found] = 1
        # may an at sign stand in it; spans of the one sort are never of the other kinds
        self._mail = self.x[:, _FEATURE["at"]] + self.x[:, _FEATURE["spelled"]] > 0

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Score of every span as every kind; a given span is of its kind only."""
        out = self.x @ weights.T
        out[~self._mail, 0] = -np.inf
        out[self._mail, 1:] = -np.inf
        for row, span in enumerate(self.spans):
            if span in self.given:
                out[row, np.arange(len(KINDS)) != self.given[span]] = -np.inf
        return out

    def marginals(self, weights: np.ndarray) -> tuple[float, np.ndarray]:
        """Logarithm of the sum over all segmentations, and each segment's probability."""
        scores = self.scores(weights)
        with np.errstate(divide="ignore"):
            merged = np.logaddexp.reduce(scores, axis=1) if len(scores) else np.zeros(0)
        ahead, back = [0.0] * (self.count + 1), [0.0] * (self.count + 1)
        into: list[list[tuple[int, float]]] = [[] for _ in range(self.count + 1)]
        out: list[list[tuple[int, float]]] = [[] for _ in range(self.count + 1)]
        for (i, j), s in zip(self.spans, merged.tolist(), strict=True):
            into[j].append((i, s))
            out[i].append((j, s))
        for j in range(1, self.count + 1):
            ahead[j] = _log_sum([ahead[j - 1], *(ahead[i] + s for i, s in into[j])])
        for i in range(self.count - 1, -1, -1):
            back[i] = _log_sum([back[i + 1], *(back[j] + s for j, s in out[i])])
        total = ahead[-1]
        base = np.array([ahead[i] + back[j] - total for i, j in self.spans])
        return total, np.exp(scores + base[:, None]) if len(scores) else scores

    def best(self, weights: np.ndarray) -> list[tuple[int, int]]:
        """(span, kind) of the best segmentation; given spans that can stand together are
        always in it."""
        scores = self.scores(weights)
        into: list[list[tuple[float, int, int]]] = [[] for _ in range(self.count + 1)]
        for row, (i, j) in enumerate(self.spans):
            kind = int(np.argmax(scores[row]))
            bonus = 1e6 if (i, j) in self.given else 0.0
            into[j].append((float(scores[row, kind]) + bonus, row, kind))
        best, back = [0.0] * (self.count + 1), [None] * (self.count + 1)
        for j in range(1, self.count + 1):
            best[j] = best[j - 1]
            for score, row, kind in into[j]:
                if best[self.spans[row][0]] + score > best[j]:
                    best[j], back[j] = best[self.spans[row][0]] + score, (row, kind)
        found, j = [], self.count
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                found.append(back[j])
                j = self.spans[back[j][0]][0]
        return found[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + float(np.log(sum(np.exp(v - top) for v in values))) if len(values) > 1 else top


# training

def _respelled(kind: str, entity: str, rng: np.random.Generator) -> str:
    """The entity as it is also written; fixed forms, drawn at random."""
    digits = "".join(_DIGITS.findall(entity))
    if kind == "phone":
        last = digits[-10:].rjust(10, "2")
        a, b, c = last[:3], last[3:6], last[6:]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1 ({a}) {b}-{c}", f"1-{a}-{b}-{c}", f"{a} {b} {c}"][rng.integers(6)]
    if kind == "email":
        return entity.replace("@", ["(at)", " (at) ", "[at]", " [at] ", " @ ", "{at}"][rng.integers(6)], 1)
    if kind == "card":
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [".", "/", " - "][rng.integers(3)].join(fours)
    return entity.replace(".", "[.]")


def _no_entity(rng: np.random.Generator) -> str:
    """A number, or an at sign, that is no personal data; fixed forms, drawn at random."""
    n = lambda low, high: int(rng.integers(low, high))
    year, month, day = n(1950, 2040), n(1, 13), n(1, 29)
    digits = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    card = digits(16)
    card = card if not luhn(card) else card[:-1] + str((int(card[-1]) + 1) % 10)
    forms = [
        f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{year}/{month:02}/{day:02} {n(0, 24):02}:{n(0, 60):02}:{n(0, 60):02}",
        f"{day:02}/{month:02}/{year}", f"978-{n(0, 10)}-{n(10, 100)}-{digits(6)}-{n(0, 10)}", f"{n(0, 100)}.{digits(8)}",
        " ".join(str(n(0, 100)) for _ in range(n(5, 12))), "-".join(str(n(0, 100)) for _ in range(n(5, 9))),
        f"{n(1990, 2030)}-{n(1990, 2030)}-{n(1990, 2030)}", f"{year} {n(1990, 2030)} {n(1990, 2030)}", card,
        " ".join(card[i : i + 4] for i in range(0, 16, 4)), f"{n(256, 999)}.{n(0, 300)}.{n(256, 999)}.{n(0, 300)}",
        digits(7), digits(8), digits(9), digits(10), digits(n(11, 16)), digits(n(20, 30)), f"{digits(3)}/{digits(5)}",
        f"{n(1, 30)}.{n(0, 30)}.{n(0, 30)}-{digits(5)}", f"{n(0, 24):02}:{n(0, 60):02}:{n(0, 60):02}.{digits(6)}",
        "shop @ noon", "x @ y", "at@home", "one (at) most",
    ]
    return forms[rng.integers(len(forms))]


def training_set(sample: list[tuple[str, int, int]], seed: int = 11) -> list[tuple[Lattice, list[tuple[int, int]]]]:
    """Lattices with their gold segments (span, kind). ``sample`` is windows with the
    place of the stretch in them."""
    rng = np.random.default_rng(seed)
    out = []

    def add(window: str, low: int, high: int, more: Span | None) -> None:
        gold = [s for s in base_spans(window) if low <= s[1] and s[2] <= high]
        if more:
            gold = [s for s in gold if s[2] <= more[1] or more[2] <= s[1]] + [more]
        lattice = Lattice(window, low, high, [])
        place = {span: row for row, span in enumerate(lattice.spans)}
        begins = {s: i for i, (s, _) in enumerate(lattice.tokens)}
        ends = {e: i + 1 for i, (_, e) in enumerate(lattice.tokens)}
        rows = [(place.get((begins.get(s, -1), ends.get(e, -1))), KINDS.index(k)) for k, s, e in gold]
        overlap = any(a[1] < b[2] and b[1] < a[2] for i, a in enumerate(gold) for b in gold[:i])
        if lattice.spans and not overlap and all(row is not None for row, _ in rows):
            out.append((lattice, rows))

    hints = {k: [w for w, h in _HINTS.items() if h == k] for k in (*KINDS, "other")}
    for window, low, high in sample:
        add(window, low, high, None)
        for kind, start, end in base_spans(window):
            if start < low or end > high:
                continue
            lead = f"{hints[kind][rng.integers(len(hints[kind]))]} " if rng.random() < 0.3 else ""
            said = _respelled(kind, window[start:end], rng)
            text = f"{window[:low]}{lead}{said}{window[high:]}"
            add(text, low + len(lead), low + len(lead) + len(said), (kind, low + len(lead), low + len(lead) + len(said)))
        lead = f"{hints['other'][rng.integers(len(hints['other']))]} " if rng.random() < 0.3 else ""
        said = _no_entity(rng)
        add(f"{window[:low]}{lead}{said}{window[high:]}", low + len(lead), low + len(lead) + len(said), None)
    return out


def train(sample: list[tuple[str, int, int]], epochs: int = EPOCHS, seed: int = 11) -> np.ndarray:
    """Weights (kind, feature) of the field by the gradient of its conditional likelihood
    (Adam). Without any stretch there is nothing to learn: weights that add nothing."""
    data = training_set(sample, seed)
    weights = np.zeros((len(KINDS), len(_NAMES)))
    if not data:
        weights[:, 0] = -1e3
        return weights
    rng, first, second, step = np.random.default_rng(seed), np.zeros_like(weights), np.zeros_like(weights), 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), 16):
            slope = PENALTY * weights
            for i in order[at : at + 16]:
                lattice, gold = data[i]
                expected = lattice.marginals(weights)[1]
                for row, kind in gold:
                    expected[row, kind] -= 1
                slope += expected.T @ lattice.x / 16
            step += 1
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
            weights -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weights


def added_spans(window: str, low: int, high: int, given: list[Span], weights: np.ndarray,
                confident: float = CONFIDENT) -> list[tuple[Span, float]]:
    """What the field adds in one stretch: spans (in the window) and their marginals."""
    lattice = Lattice(window, low, high, given)
    found = [(row, kind) for row, kind in lattice.best(weights) if lattice.spans[row] not in lattice.given]
    if not found:
        return []
    marginal = lattice.marginals(weights)[1]
    out = []
    for row, kind in found:
        i, j = lattice.spans[row]
        if marginal[row, kind] >= confident:
            out.append(((KINDS[kind], lattice.tokens[i][0], lattice.tokens[j - 1][1]), float(marginal[row, kind])))
    return out


# on tables

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_STRETCH = pa.struct([("at", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("window", pa.string())])
_SPAN_DDL = "struct<kind:string,start:int,end:int>"
_SCAN_DDL = f"id long, base array<{_SPAN_DDL}>, stretches array<struct<at:int,low:int,high:int,window:string>>"


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", TEXT_BYTES):
        text = part.column("text")
        may = pc.fill_null(pc.match_substring_regex(text, _MAY_HOLD), False)
        base: list = [[] for _ in range(part.num_rows)]
        held: list = [[] for _ in range(part.num_rows)]
        for i in np.flatnonzero(may.to_numpy(zero_copy_only=False)).tolist():
            whole = text[i].as_py()
            base[i] = base_spans(whole)
            for start, end in stretches(whole):
                at = max(0, start - CONTEXT)
                held[i].append((at, start - at, end - at, whole[at : end + CONTEXT]))
        yield pa.RecordBatch.from_arrays([
            part.column("id"),
            pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans] for spans in base], pa.list_(_SPAN)),
            pa.array([[dict(zip(("at", "low", "high", "window"), s, strict=True)) for s in found] for found in held], pa.list_(_STRETCH)),
        ], names=["id", "base", "stretches"])


def _decode(weights, confident: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = weights.value
        for batch in batches:
            added = []
            for base, held in zip(batch.column("base").to_pylist(), batch.column("stretches").to_pylist(), strict=True):
                found = []
                for s in held:
                    given = [(b["kind"], b["start"] - s["at"], b["end"] - s["at"]) for b in base
                             if b["start"] < s["at"] + s["high"] and s["at"] + s["low"] < b["end"]]
                    for (kind, start, end), score in added_spans(s["window"], s["low"], s["high"], given, learned, confident):
                        found.append({"kind": kind, "start": start + s["at"], "end": end + s["at"], "score": score,
                                      "text": s["window"][start:end]})
                added.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("base"), pa.array(added, pa.list_(pa.struct(
                    [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
                     ("text", pa.string())])))], names=["id", "base", "added"])

    return run


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
    epochs: int = EPOCHS, confident: float = CONFIDENT,
) -> DataFrame:
    """Per document: its id, ``base`` (spans of the fixed patterns: kind, start, end) and
    ``added`` (the field's spans, with score and text); offsets in code points, ends
    exclusive, both by kind and then start.

    A NULL or empty text has no spans. Repeated rows give repeated results, a NULL id stays
    NULL, other columns are not read, an empty table gives an empty table. ``sample`` bounds
    the stretches the field learns from; those of smallest hash are taken, so it does not
    depend on the order of rows. A corpus without any stretch adds nothing.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scanned = staged(rows.mapInArrow(_scan, _SCAN_DDL), "stretches")
    # stretches with base spans and others, half each if there are enough
    each = scanned.filter("size(stretches) > 0").select("base", F.explode("stretches").alias("s")).select(
        F.exists("base", lambda b: (b["start"] < F.col("s.at") + F.col("s.high")) & (F.col("s.at") + F.col("s.low") < b["end"])).alias("given"),
        F.col("s.window").alias("window"), F.col("s.low").alias("low"), F.col("s.high").alias("high"))
    learned = each.filter("given and high - low <= 400").select("window", "low", "high").distinct()
    rows = learned.orderBy(F.xxhash64("window", "low"), "window", "low").limit(sample).collect()  # at most ``sample`` short windows
    weights = docs.sparkSession.sparkContext.broadcast(train([tuple(r) for r in rows], epochs))
    order = F.array(*map(F.lit, KINDS))
    by_kind = lambda c: F.array_sort(c, lambda a, b: F.when(
        a["kind"] == b["kind"], a["start"] - b["start"]).otherwise(F.array_position(order, a["kind"]) - F.array_position(order, b["kind"])).cast("int"))
    found = scanned.mapInArrow(_decode(weights, confident), (
        f"id long, base array<{_SPAN_DDL}>, added array<struct<kind:string,start:int,end:int,score:double,text:string>>"))
    return found.select(F.col("id").alias(id_col), "base", by_kind("added").alias("added"))


def personal_data_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """Per document: its id, counts of base spans by kind, the SHA-256 of the base spans
    written as kind:start:end (by kind, then start, joined by commas), and all spans
    written likewise."""
    found = find_personal_data(docs, id_col, text_col, **settings)
    written = lambda c: F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    plain = f"array<{_SPAN_DDL}>"
    every = F.concat(F.col("base"), F.transform("added", lambda s: F.struct(s["kind"], s["start"], s["end"])).cast(plain))

    def of(spans, kind: str):
        return F.filter(spans, lambda s: s["kind"] == kind)

    spans = F.concat(*[F.array_sort(of(every, k)) for k in KINDS])
    return found.select(
        id_col, *[F.size(of(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(written(F.col("base")), ","), 256).alias("base_sha256"),
        F.array_join(written(spans), ",").alias("spans"))
