"""Secret scans: fixed patterns, and password guess-cost dynamic programming on values in a credential context."""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, mapped, slices, texts

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
#: Maximal runs: a run that is too short has no long enough match further right.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Any key that announces a credential, and its value: quoted, or up to white space.
CONTEXT = re.compile(
    r"""(?<![a-z0-9])(?:[a-z0-9]*_)?(?:password|passwd|passphrase|passcode|pwd|secret|token|api_?key|access_?key|auth|credentials?|private_?key)["']?\x20*[:=]\x20*(?:"([^"\n]{6,})"|'([^'\n]{6,})'|([^\s"',;<>]{6,}))""",
    re.ASCII | re.IGNORECASE,
)
#: Each text that a pattern can match holds one of these in lower case.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CONTEXT_HINTS = (*ASSIGN_HINTS, "passphrase", "passcode", "pwd", "accesskey", "access_key", "auth", "credential", "privatekey", "private_key")
HEXLIKE = bytes(104 if chr(b) in "0123456789abcdef" else 46 for b in range(256))

# The commonest passwords and placeholders, most frequent first, and the rows of a keyboard. Further words come
# from a vocabulary file.
WORDS = """password love welcome secret admin monkey dragon master letmein login princess football baseball shadow
sunshine iloveyou superman batman trustno hello freedom whatever qazwsx michael jordan hunter ranger thomas robert
summer winter spring autumn monday friday october computer internet server system database public private access
user guest root test demo sample example changeme default temp temporary company office network security manager
the and for you are not this that with have from your example token key api pass word my our new old one two
dev prod stage staging local home work house green blue black white orange yellow purple silver gold angel cookie
cheese pepper ginger banana apple coffee chocolate flower butterfly tiger lion eagle wolf horse dog cat bird fish
star moon sun sky fire water earth wind rock river ocean mountain music guitar piano dance soccer hockey tennis
george charlie daniel andrew joshua matthew jessica jennifer ashley amanda nicole maggie buster harley corvette
correct battery staple none null undefined true false placeholder redacted hidden value string here insert""".split()
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz", "!@#$%^&*()_+")
LEET = str.maketrans("430157@$!", "aeoistasi")

NEXT = {(a, b) for row in KEYBOARD for a, b in zip(row, row[1:], strict=False)} | {(b, a) for row in KEYBOARD for a, b in zip(row, row[1:], strict=False)}
DATE = re.compile(r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)?\d\d", re.ASCII)
#: Bits a guesser spends on choosing another segment's kind, on a walk or a repeated character, and on spelling a word in other signs.
SWITCH_BITS, WALK_BITS, SAME_BITS, LEET_BITS = 2.0, 7.0, 5.0, 1.5
#: Values of up to so many characters have their costs remembered, so many of them.
REMEMBERED, MOST_REMEMBERED = 64, 1 << 14


class Words(dict):
    """Ranks of words by frequency: the commonest passwords, then the vocabulary's whole words of three letters or more, which
    such files list by the order in which they were merged. vocabulary: a tokenizer file whose words end in </w>; none if None."""

    def __init__(self, vocabulary: str | None = None):
        super().__init__()
        more: list[str] = []
        if vocabulary:
            with open(vocabulary) as f:
                ids = json.load(f)["model"]["vocab"]
            words = (token.removesuffix("</w>") for token in sorted(ids, key=ids.get) if token.endswith("</w>"))
            more = [w for w in words if len(w) > 2 and w.isascii() and w.isalpha()]
        for word in (*WORDS, *more):
            self.setdefault(word, len(self) + 1)
        self.longest = max(map(len, self))


@functools.cache
def words_of(vocabulary: str | None) -> Words:
    return Words(vocabulary)


def brute_bits(c: str) -> float:
    return math.log2(10) if c.isdigit() else math.log2(26) if c.isascii() and c.isalpha() else math.log2(33) if c.isascii() else 12.0


def _ends(value: str, joined) -> list[int]:
    """For each place the end of the run that it is in, where `joined` says which neighbours belong together."""
    ends = [len(value)] * len(value)
    for i in range(len(value) - 2, -1, -1):
        if not joined(value[i], value[i + 1]):
            ends[i] = i + 1
        else:
            ends[i] = ends[i + 1]
    return ends


def guess_cost(value: str, words: Words, enough: float = math.inf) -> tuple[float, str]:
    """Least bits of guessing over all segmentations of the value, and the kinds of the best one's segments. A cost of `enough`
    or more is told as at least that, with no kinds.

    A segment is a word, a date, a keyboard walk or repeated character of three or more, a unit of two or more characters
    repeated twice or more (its last copy may be cut short), or a brute-force character; each change of segment costs
    SWITCH_BITS, but for brute force after brute force. best[j] is the least cost of value[:j]; only places that cost less
    than `enough` are gone on from. A segment of a run starts where the run does or where one of another kind ended: to start
    later than that is never cheaper, since a character more costs a run less than a bit.
    """
    n = len(value)
    low = value.lower()
    if len(low) != n:  # letters whose lower case is longer
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = low.translate(LEET)
    walk = _ends(low, lambda a, b: (a, b) in NEXT)
    same = _ends(value, lambda a, b: a == b)
    bits = list(map(brute_bits, value))
    upper = list(itertools.accumulate((c.isupper() for c in value), initial=0))
    best, raw = [math.inf] * (n + 1), [math.inf] * (n + 1)
    last: list[tuple[int, str]] = [(0, "")] * (n + 1)
    best[0] = 0.0
    reach = 0

    def offer(j: int, cost: float, i: int, kind: str) -> None:
        nonlocal reach
        if cost < best[j] and cost < enough:
            best[j], last[j], reach = cost, (i, kind), max(reach, j)

    for i in range(n):
        if i > reach:
            return enough, ""
        if min(best[i], raw[i]) >= enough:
            continue
        before = last[i][1]
        base = best[i] + (SWITCH_BITS if i else 0.0)
        one = (min(raw[i], base) if i else 0.0) + bits[i]
        if one < enough:
            raw[i + 1] = one
            offer(i + 1, one, i, "brute")
            reach = max(reach, i + 1)
        if best[i] >= enough:
            continue
        for j in range(i + 3, min(n, i + words.longest) + 1):
            for form, extra in ((low, 0.0), (plain, LEET_BITS)):
                if rank := words.get(form[i:j]):
                    big = upper[j] - upper[i]
                    offer(j, base + math.log2(rank + 1) + extra + (0 if not big else 1 if big in (1, j - i) else big), i, "word")
                    break
        if m := DATE.match(value, i):
            offer(m.end(), base + math.log2(150 if m.end() - i == 4 else 365 * 150), i, "date")
        for kind, ends, cost in (("walk", walk, WALK_BITS), ("same", same, SAME_BITS)):
            if (before not in (kind, "brute") or not i or ends[i - 1] == i) and ends[i] - i > 2:
                for j in range(i + 3, ends[i] + 1):
                    offer(j, base + cost + math.log2(j - i), i, kind)
        unit = sum(bits[i : i + 2])
        for period in range(2, (n - i) // 2 + 1):
            if base + unit >= enough:
                break
            inside = i > 0 and value[i - 1] == value[i + period - 1]
            if not inside or before not in (f"unit{period}", "brute"):
                j = i + period
                while j < n and value[j] == value[j - period]:
                    j += 1
                    if j - i >= 2 * period:
                        offer(j, base + unit + math.log2((j - i) // period + 1), i, f"unit{period}")
            unit += bits[i + period]
    if best[n] >= enough:
        return enough, ""
    kinds, j = [], n
    while j:
        i, kind = last[j]
        kinds.append("repeat" if kind == "same" or kind.startswith("unit") else kind)
        j = i
    return best[n], "+".join(k for k, _ in itertools.groupby(reversed(kinds)))


class Costs(dict):
    """Whether values cost at least so many bits, remembered for short values, which recur."""

    def __init__(self, words: Words, least_bits: float):
        super().__init__()
        self.words, self.least_bits = words, least_bits

    def __missing__(self, value: str) -> bool:
        costly = guess_cost(value, self.words, self.least_bits)[0] >= self.least_bits
        if len(value) <= REMEMBERED:
            if len(self) >= MOST_REMEMBERED:
                self.clear()
            self[value] = costly
        return costly


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the fixed patterns, in code points."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if b"h" * 32 in text.encode("utf-8", "surrogatepass").translate(HEXLIKE):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guessed_spans(text: str, costly: Costs) -> list[tuple[int, int, int]]:
    """(start, 3, end) of credential-context values that are costly to guess."""
    low = text.lower()
    if not any(h in low for h in CONTEXT_HINTS):
        return []
    out = []
    for m in CONTEXT.finditer(text):
        k = next(k for k in (1, 2, 3) if m.group(k) is not None)
        if costly[m.group(k)]:
            out.append((m.start(k), 3, m.end(k)))
    return out


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{i}:{j}" for i, k, j in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    out, at = [], 0
    for i, _, j in spans:
        if i >= at:
            out += [text[at:i], mark]
        at = max(at, j)
    return "".join([*out, text[at:]])


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string"


def scan(docs: DataFrame, least_bits: float = 36.0, vocabulary: str | None = None) -> DataFrame:
    """Secrets of each text: a row a document with the counts by kind, spans (kind:start:end by start) and base_sha256.

    base_sha256 is the digest of the fixed patterns' spans alone; the guess-cost spans come on top and take nothing away.
    Null and empty texts have no spans, and the digest of an empty string. An empty table gives no rows; repeated rows give
    theirs each; other columns aren't read. vocabulary: a tokenizer file, at the same path everywhere, for the words of guesses.
    """

    def run(batches):
        costly = Costs(words_of(vocabulary), least_bits)
        for batch in batches:
            for part in slices(batch):
                rows = []
                for text in part.column("text").to_pylist():
                    base = base_spans(text)
                    more = guessed_spans(text, costly)
                    kinds = [k for _, k, _ in base]
                    rows.append((kinds.count(0), kinds.count(1), kinds.count(2), len(more), hashlib.sha256(shown(base).encode()).hexdigest(), shown(sorted(base + more))))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:4]], *[pa.array(c, pa.string()) for c in cols[4:]]], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return mapped(texts(docs), run, SCHEMA)


def redact(docs: DataFrame, least_bits: float = 36.0, vocabulary: str | None = None) -> DataFrame:
    """docs in its own columns, each found span of text replaced by a mark, and n_chars set anew where there is one.

    Spans that overlap (ties among kinds too) give one mark for the first and none for what it covers. Null and empty texts stay
    as they are, and every row stays, repeated ones too; an empty table gives no rows.
    """
    at, schema = docs.columns.index("text"), docs.schema
    sizes = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    arrow = arrow_schema(schema)

    def run(batches):
        costly = Costs(words_of(vocabulary), least_bits)
        for batch in batches:
            for part in slices(batch):
                texts = part.column(at).to_pylist()
                clean = [t if t is None else redacted(t, s) if (s := sorted(base_spans(t) + guessed_spans(t, costly))) else t for t in texts]
                cols = list(part.columns)
                cols[at] = pa.array(clean, arrow.field(at).type)
                if sizes is not None:
                    old = part.column(sizes).to_pylist()
                    cols[sizes] = pa.array([n if c is t or t is None else len(c) for n, t, c in zip(old, texts, clean, strict=True)], arrow.field(sizes).type)
                yield pa.RecordBatch.from_arrays(cols, names=part.schema.names)

    return mapped(docs, run, schema)
