"""Personal data: identifiers as written, and identifiers in disguise, with offsets into the source text.

Base spans are what four fixed patterns find in the text itself. For the rest transducers rewrite the text: homoglyphs and
full-width forms become ASCII, invisible characters vanish, spelled digits become digits, and "at", "dot" and "plus" in brackets or
between the parts of an address become their signs, in English, Spanish, French and German. Each rewritten piece keeps the bounds of
its source, so a span found in the rewritten text maps back to code points of the source. A found span that meets no base span of its
kind is added, and so is a phone number of which the base span lacks the end, as that is spelled.

Each transducer passes once from left to right. One goes over digits and number words: what stands between two of them is a few
characters, looked at once, and either continues the run or ends it. The other goes over signs for @: from each it walks back over the local
part, never past the sign before, and on over the domain. So work is linear in the text.

Edge cases: a null text is an empty one. Repeated rows are treated alike, each by itself. The counts are of base spans only.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import textarrays as ta
from terravane.llm.jobs import read_table, with_columns_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# Fixed patterns. The e-mail pattern is split at its @, the others start at the first digit of a run.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_REST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches: before each @ the run of local characters back to the last match or another character."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := EMAIL_REST.match(text, at)):
            yield "email", start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """Spans as written, by start, then by kind as KINDS lists them."""
    found = list(emails(text)) if "@" in text else []
    if DIGIT.search(text):
        if "." in text:
            for m in IP.finditer(text):
                if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.group().split(".")):
                    found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


#: Homoglyphs of ASCII letters, digits and signs.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ո": "n", "ѵ": "v", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ѕ": "S",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Ζ": "Z",
    "․": ".", "。": ".", "｡": ".", "‐": "-", "‑": "-", "–": "-", "−": "-", "﹫": "@",
}
HOMOGLYPHS |= {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
for _first in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):
    HOMOGLYPHS |= {chr(_first + d): str(d) for d in range(10)}
INVISIBLE = "­​‌‍⁠﻿"
# Words for digits and signs, in four languages.
NUMBER_WORDS = [
    ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"],
    ["cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"],
    ["zéro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"],
    ["null", "eins", "zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun"],
]
SPELLED = {word: str(digit) for words in NUMBER_WORDS for digit, word in enumerate(words)} | {"oh": "0", "zwo": "2", "fuenf": "5"}
DOT_WORDS = ["dot", "punto", "point", "punkt"]
AT_WORDS = ["at", "arroba", "arobase", "klammeraffe"]
PLUS_WORDS = ["plus", "más", "mas"]
#: This word for @ means other things too: without brackets it counts only where the domain's dots are disguised.
COMMON_AT = "at"

_one_of = lambda words: "|".join(sorted(words, key=len, reverse=True))
_WORD, _DOT, _AT = _one_of(SPELLED), _one_of(DOT_WORDS), _one_of(AT_WORDS)
_IN_BRACKETS = r"[\x20]?[(\[{{<][\x20]?(?:{0})[\x20]?[)\]}}>][\x20]?"
_SPOKEN_DOT = rf"(?:{_IN_BRACKETS.format(_DOT + '|' + chr(92) + '.')}|[\x20](?:{_DOT})[\x20])"
AT = re.compile(rf"{_IN_BRACKETS.format(_AT + '|@')}|[\x20](?:{_AT}|@)[\x20]|@", re.I)
DOT = re.compile(rf"{_SPOKEN_DOT}|\.", re.I)
DOT_BEFORE = re.compile(rf"(?:{_SPOKEN_DOT}|\.)\Z", re.I)
ATOM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")
LABEL = re.compile(r"[A-Za-z0-9-]+")

#: A group of digits or a number word.
GROUP = re.compile(rf"(?<![A-Za-z0-9])[0-9]++(?![A-Za-z0-9])|(?<!\w)(?:{_WORD})(?!\w)", re.I)
_BARE_DOT = rf"[(\[{{<][\x20]?(?:{_DOT}|\.)[\x20]?[)\]}}>]|[(\[{{]?\b(?:{_DOT})\b[)\]}}]?"
#: What may stand between groups of a run; the gap vanishes or is a dot.
GAP = re.compile(rf"[\x20,-]{{1,2}}|(?P<dot>[\x20]?(?:\.|{_BARE_DOT})[\x20]?)", re.I)
#: The same before a run's only number word, if that ends the run: no gap that may end a clause.
CLOSE_GAP = re.compile(rf"[\x20-]{{1,2}}|,|\.|[\x20]\.[\x20]|[\x20]?(?:{_BARE_DOT})[\x20]?", re.I)
PLUS_BEFORE = re.compile(rf"(?:(?<!\w)(?:{_one_of(PLUS_WORDS)})[\x20]|\+[\x20]?)\Z", re.I)
#: Characters that a sign or gap, and a plus, take at most.
LONGEST_GAP = 4 + max(map(len, DOT_WORDS)) + 1
LONGEST_PLUS = max(map(len, PLUS_WORDS)) + 1
#: Without any of these a rewritten text equals the source.
GLYPHS = re.compile("[" + re.escape("".join(HOMOGLYPHS)) + INVISIBLE + "]")
#: A lower-cased text has no sign in disguise without one of these, and no disguised number without a word of NUMBERS next to a group.
SIGNS = [*DOT_WORDS, *(w for w in AT_WORDS if w != COMMON_AT), " @ ", *(f"{b}{gap}{x}" for b in "([{<" for gap in ("", " ") for x in ("at", "@", "."))]
NUMBERS = sorted(SPELLED)
GROUP_AFTER = re.compile(rf"[\x20,.-]{{1,2}}(?:[0-9]|(?:{_WORD})(?!\w))|[\x20]?[(\[{{<]")
GROUP_BEFORE = re.compile(r"[0-9][\x20,.-]{1,2}\Z|[)\]}>][\x20]?\Z")


class Rewritten:
    """Text after transducers, and for each of its characters the bounds of its source."""

    def __init__(self, text: str):
        self.text, self.lows, self.highs, self.sources = text, [0], [len(text)], [0]

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans of the present text, given in order, each by a string."""
        if not edits:
            return
        out, pieces, done = [], [], 0
        for a, b, new in edits:
            if a > done:
                out.append(self.text[done:a])
                pieces += self._pieces(done, a)
            if new:
                low, high = self.source(a)[0], self.source(b - 1)[1]
                out.append(new)
                pieces.append((len(new), low, high, False))
            done = b
        if done < len(self.text):
            out.append(self.text[done:])
            pieces += self._pieces(done, len(self.text))
        self.text = "".join(out)
        self.sources, self.lows, self.highs, self.straight, at = [], [], [], [], 0
        for n, low, high, straight in pieces:
            self.sources.append(at)
            self.lows.append(low)
            self.highs.append(high)
            self.straight.append(straight)
            at += n

    straight: list[bool] = [True]

    def _pieces(self, a: int, b: int) -> list[tuple[int, int, int, bool]]:
        """Stretches a:b of the present text: length, source bounds, and whether characters map one to one."""
        found = []
        i = bisect_right(self.sources, a) - 1
        while i < len(self.sources) and self.sources[i] < b:
            start = max(a, self.sources[i])
            end = min(b, self.sources[i + 1] if i + 1 < len(self.sources) else len(self.text))
            if self.straight[i]:
                low = self.lows[i] + start - self.sources[i]
                found.append((end - start, low, low + end - start, True))
            elif end > start:
                found.append((end - start, self.lows[i], self.highs[i], False))
            i += 1
        return found

    def source(self, at: int) -> tuple[int, int]:
        """Source bounds of one character."""
        i = bisect_right(self.sources, at) - 1
        if self.straight[i]:
            low = self.lows[i] + at - self.sources[i]
            return low, low + 1
        return self.lows[i], self.highs[i]


def addresses(text: str) -> list[tuple[int, int, list[tuple[int, int, str]]]]:
    """Addresses in disguise: start, end, and the edits that make them plain."""
    found, low = [], 0
    for sign in AT.finditer(text):
        at, start, signs = sign.start(), sign.start(), []
        while True:
            atom = start
            while atom > low and text[atom - 1] in ATOM:
                atom -= 1
            if atom == start:
                break
            start = atom
            dot = DOT_BEFORE.search(text, max(low, atom - LONGEST_GAP), atom)
            if not dot or dot.start() <= low or text[dot.start() - 1] not in ATOM:
                break
            signs.append(dot.span())
            start = dot.start()
        low = sign.end()
        label = LABEL.match(text, low)
        if start == at or not label:
            continue
        bare, end, dots = sign.group().strip().lower() == COMMON_AT, label.end(), []
        while (dot := DOT.match(text, end)) and not (bare and dot.group() == ".") and (label := LABEL.match(text, dot.end())):
            dots.append(dot.span())
            end = label.end()
        signs += dots
        if dots and (sign.group() != "@" or any(text[a:b] != "." for a, b in signs)):
            found.append((start, end, sorted([(*sign.span(), "@"), *((a, b, ".") for a, b in signs)])))
            low = end
    return found


@functools.lru_cache(4096)
def _gap(between: str) -> str | None:
    m = GAP.fullmatch(between)
    return None if not m else "." if m["dot"] else ""


def _run_edits(text: str, run: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """What makes a run of groups plain. A gap lies between each two of them."""
    words = [not text[a].isdigit() for a, _ in run]
    if len(run) > 1 and sum(words) == 1 and words[-1] and not CLOSE_GAP.fullmatch(text[run[-2][1] : run[-1][0]]):
        run, words = run[:-1], words[:-1]
    if len(run) < 2:
        return []
    gaps = [(a, b, _gap(text[a:b])) for (_, a), (b, _) in zip(run, run[1:])]
    if not any(words):
        return [(a, b, ".") for a, b, kind in gaps if kind and text[a:b] != "."]
    plus = PLUS_BEFORE.search(text, max(0, run[0][0] - LONGEST_PLUS), run[0][0])
    return sorted([*([(*plus.span(), "+")] if plus else []), *gaps, *((a, b, SPELLED[text[a:b].lower()]) for (a, b), word in zip(run, words) if word)])


def run_edits(text: str, apart: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """Edits of all runs of digits and number words outside the spans `apart`."""
    edits: list[tuple[int, int, str]] = []
    run: list[tuple[int, int]] = []
    k = 0
    for m in GROUP.finditer(text):
        a, b = m.span()
        while k < len(apart) and apart[k][1] <= a:
            k += 1
        inside = k < len(apart) and apart[k][0] < b
        if run and (inside or a - run[-1][1] > LONGEST_GAP or _gap(text[run[-1][1] : a]) is None):
            edits += _run_edits(text, run)
            run = []
        if not inside:
            run.append((a, b))
    return edits + _run_edits(text, run)


def _has_numbers(low: str) -> bool:
    """Whether a number word of a lower-cased text stands next to another group of digits, or a bracket."""
    for word in NUMBERS:
        at = low.find(word)
        while at >= 0:
            end = at + len(word)
            if not (at and low[at - 1].isalnum()) and not low[end : end + 1].isalnum() and (GROUP_AFTER.match(low, end) or GROUP_BEFORE.search(low, max(0, at - 3), at)):
                return True
            at = low.find(word, end)
    return False


def rewrite(text: str) -> Rewritten | None:
    """The text without disguises; None where nothing is disguised."""
    glyphs = None if text.isascii() else GLYPHS.search(text)
    out = Rewritten(text)
    if glyphs:
        out.apply([(m.start(), m.end(), HOMOGLYPHS.get(m.group(), "")) for m in GLYPHS.finditer(text)])
    low = out.text.lower()
    signs = any(sign in low for sign in SIGNS)
    numbers = _has_numbers(low)
    if not glyphs and not signs and not numbers:
        return None
    found = addresses(out.text) if signs else []
    edits = [e for _, _, own in found for e in own]
    if signs or numbers:
        edits += run_edits(out.text, [(a, b) for a, b, _ in found])
    out.apply(sorted(edits))
    return out


TOP_LEVEL = re.compile(r"\.[A-Za-z]{2,24}$")


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start and kind."""
    base = base_spans(text)
    out = rewrite(text)
    if out is None:
        return base, base
    taken = {k: [(a, b) for kind, a, b in base if kind == k] for k in KINDS}
    extra = []
    for kind, a, b in base_spans(out.text):
        low, high = out.source(a)[0], out.source(b - 1)[1]
        own = taken[kind]  # apart from each other, and in order
        met = []
        for i in range(max(0, bisect_right(own, (low, low)) - 1), len(own)):
            if own[i][0] >= high:
                break
            if low < own[i][1]:
                met.append(own[i])
        longer = kind == "phone" and all(low <= x and y < high for x, y in met)  # the base span lacks the spelled end
        if out.text[a:b] == text[low:high] or met and not longer:
            continue  # not in disguise, or a base span already
        if kind == "email" and not TOP_LEVEL.search(out.text[a:b]):
            continue
        extra.append((kind, low, high))
    return base, sorted({*base, *extra}, key=lambda s: (s[1], KINDS.index(s[0]), s[2])) if extra else base


def told(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in angle brackets."""
    out, done = [], 0
    for kind, a, b in spans:
        if a >= done:
            out += [text[done:a], f"<{kind}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans, for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches):
            found = [all_spans(t or "") for t in batch.column(1).to_pylist()]
            n = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
            yield pa.record_batch([batch.column(0), *n, pa.array([sha256(told(base).encode()).hexdigest() for base, _ in found]), pa.array([told(every) for _, every in found])], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(run, schema)


def mask(docs: DataFrame) -> DataFrame:
    """docs with the personal data in text masked; a text without any, null too, stays as it is, and so do all other columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches):
            texts = [t and masked(t, all_spans(t)[1]) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return with_columns_of(docs.mapInArrow(run, docs.schema), docs)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return find(read_table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with personal data masked."""
    return mask(docs)
