"""Personal data by a semi-Markov conditional random field.

Four kinds are looked for: email, ip, card, phone. Rules give the base spans. The random field then scores whole segments: a
candidate is a run of at most ``LONGEST`` tokens, described by features of the whole span (digits, groups, checksum, signs,
neighbours), and a dynamic programme over tokens jointly chooses boundaries and kinds. Segments that it finds and that no base
span touches are added; base spans always stay.

The weights are trained on each call (a second or two): by gradient ascent on the conditional likelihood (forward and backward
sums over all segmentations), on spans made by a seeded generator, with disguises and look-alikes, and on at most ``SAMPLE``
documents of the corpus with digits or an at sign, of at most ``PER_DOCUMENT`` regions each, labelled by the rules.

Only regions are looked at, white-space-free chunks with a digit, an at sign or a disguised one, (at) or [at], and their direct neighbours of the same sort;
the rules and the field read them in whole texts, in time linear in the text.

Edge cases. Null texts count as empty: no spans; redaction leaves them null. Spans are in code points, end exclusive, ordered
by start, then kind as listed. Repeated rows give equal spans; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lakestrata.llm.common import arrow_batches

#: The kinds, in order.
KINDS = ("email", "ip", "card", "phone")
LONGEST = 24
SAMPLE = 300
PER_DOCUMENT = 10
EPOCHS = 6
RATE = 0.2
SEED = 11

Span = tuple[int, int, int]  # start, end, number of the kind

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: A disguised at sign; what makes a chunk a candidate.
_DISGUISE = re.compile(r"[(\[][Aa][Tt][)\]]")
_CUE = re.compile(r"[0-9@]|" + _DISGUISE.pattern)
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _parts_fit(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]  # a part may have any number of zeros before it
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """What the rules find: leftmost, non-overlapping per kind; a match that fails its test is dropped, not retried."""
    out: list[Span] = []
    at, last = text.find("@"), 0
    while at >= 0:  # a match has the first at sign after its run of local signs, so it is sought from there
        a = at
        while a > last and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append((a, m.end(), 0))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if _DIGIT.search(text):
        out += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if _parts_fit(m[0])]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            out += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Where chunks with a digit, an at sign or a disguised one are, neighbours with one sign between them together."""
    start = end = -1
    m = _CUE.search(text)
    while m:
        a = m.start()
        while a > max(end, 0) and not text[a - 1].isspace():
            a -= 1
        b, n = m.end(), len(text)
        while b < n and not text[b].isspace():
            b += 1
        if start >= 0 and a - end > 1:
            yield start, end
            start = a
        elif start < 0:
            start = a
        end = b
        m = _CUE.search(text, b)
    if start >= 0:
        yield start, end


def _features(text: str, a: int, b: int) -> list[str]:
    """Features of the segment text[a:b] as a whole."""
    s = text[a:b]
    digits = "".join(c for c in s if "0" <= c <= "9")
    letters = sum(c.isalpha() for c in s)
    dots, ats = s.count("."), s.count("@")
    n = len(digits)
    out = ["bias", f"digits{min(n, 20)}", f"letters{min(letters, 3)}", f"at{min(ats, 2)}", f"dots{min(dots, 5)}", f"first{_sort(s[0])}", f"last{_sort(s[-1])}",
           f"groups{min(len(re.findall(r'[0-9]+', s)), 7)}", f"size{min(len(s) // 4, 10)}",
           f"before{_sort(text[a - 1]) if a else '_'}", f"after{_sort(text[b]) if b < len(text) else '_'}"]
    out += [f"has{c}" for c in "+()- [:/=_" if c in s]
    out.append(f"disguise{'(at)' in s.lower() or '[at]' in s.lower()}")
    if not letters and n >= 12:
        out.append(f"luhn{luhn(digits)}{n >= 14}")
    if dots == 3 and n + 3 == len(s):
        out.append(f"quad{all(s.split('.')) and _parts_fit(s)}")
    host = re.split(r"@|\(at\)|\[at\]", s, flags=re.I)
    if len(host) == 2:
        out.append(f"host{bool(_DOMAIN.fullmatch(host[1]))}{bool(re.fullmatch(r'[A-Za-z0-9._%+-]+', host[0]))}")
    if s.count("(") != s.count(")"):
        out.append("unbalanced")
    return out


def _sort(c: str) -> str:
    return "9" if "0" <= c <= "9" else "a" if c.isalnum() else "_" if c.isspace() else c


def _segments(text: str) -> tuple[list[int], list[tuple[int, int, list[str]]]]:
    """Token starts (and the end), and candidate segments (first token, after the last token, features)."""
    ends = [m.end() for m in _TOKEN.finditer(text)]
    cuts = [0, *ends]
    n = len(ends)
    digit, marks = [0] * (n + 1), [0] * (n + 1)
    for i in range(n):
        s = text[cuts[i] : cuts[i + 1]]
        digit[i + 1] = digit[i] + (len(s) if "0" <= s[0] <= "9" else 0)
        marks[i + 1] = marks[i] + (s == "@" or s.lower() == "at" and i > 0 and text[cuts[i] - 1] in "([")
    out = []
    for i in range(n):
        a = cuts[i]
        if text[a].isspace() or (a and text[a - 1].isalnum()):
            continue
        for j in range(i + 1, min(n, i + LONGEST) + 1):
            b = cuts[j]
            if not text[b - 1].isalnum() or (b < len(text) and text[b].isalnum()):
                continue
            found = digit[j] - digit[i]
            if marks[j] - marks[i] == 1 or 7 <= found <= 24 or (found >= 4 and text.count(".", a, b) == 3):
                out.append((i, j, _features(text, a, b)))
    return cuts, out


Weights = dict[str, list[float]]
_NONE = [0.0] * len(KINDS)


def _score(weights: Weights, features: list[str]) -> list[float]:
    rows = [weights.get(f, _NONE) for f in features]
    return [sum(r[k] for r in rows) for k in range(len(KINDS))]


def _log_add(xs: list[float]) -> float:
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs))


def _gradient(weights: Weights, n: int, segments: list, gold: set[tuple[int, int, int]], rate: float) -> None:
    """One step up the conditional likelihood of the segmentation ``gold`` of ``n`` tokens."""
    scores = [_score(weights, f) for _, _, f in segments]
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    by_start: list[list[int]] = [[] for _ in range(n + 1)]
    for c, (i, j, _) in enumerate(segments):
        by_end[j].append(c)
        by_start[i].append(c)
    forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        forward[j] = _log_add([forward[j - 1], *(forward[segments[c][0]] + s for c in by_end[j] for s in scores[c])])
    for i in range(n - 1, -1, -1):
        backward[i] = _log_add([backward[i + 1], *(backward[segments[c][1]] + s for c in by_start[i] for s in scores[c])])
    for c, (i, j, features) in enumerate(segments):
        for k in range(len(KINDS)):
            p = math.exp(forward[i] + scores[c][k] + backward[j] - forward[n])
            d = rate * (((i, j, k) in gold) - p)
            if abs(d) > 1e-6:
                for f in features:
                    weights.setdefault(f, [0.0] * len(KINDS))[k] += d


def decode(weights: Weights, text: str) -> list[Span]:
    """The best segmentation of one region."""
    cuts, segments = _segments(text)
    if not segments:
        return []
    n = len(cuts) - 1
    by_end: dict[int, list] = {}
    for i, j, f in segments:
        s = _score(weights, f)
        k = max(range(len(KINDS)), key=s.__getitem__)
        by_end.setdefault(j, []).append((i, k, s[k]))
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for i, k, s in by_end.get(j, ()):
            if best[i] + s > best[j]:
                best[j], back[j] = best[i] + s, (i, k)
    out, j = [], n
    while j:
        if back[j] is None:
            j -= 1
        else:
            i, k = back[j]
            out.append((cuts[i], cuts[j], k))
            j = i
    return out[::-1]


def _made(rng: random.Random) -> tuple[str, list[Span]]:
    """A region of the generator: one span of a kind, perhaps disguised, or a look-alike that is none."""
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, n)))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    kind = rng.randrange(7)
    if kind == 0:
        at = rng.choice(["@", "@", "@", "(at)", "[at]"])
        s = rng.choice([word(9), f"{word(6)}.{number(2)}", f"{word(5)}_{word(5)}"]) + at + rng.choice([word(8), f"{word(6)}{number(1)}"]) + "." + rng.choice([word(3), f"example.{word(3)}"])
    elif kind == 1:
        s = ".".join(str(rng.randint(0, 255)) for _ in range(4))
    elif kind == 2:
        body = number(rng.choice([13, 14, 15, 15, 15, 18]))
        check = next(c for c in "0123456789" if luhn(body + c))
        s = rng.choice(["", " ", "-", "."]).join(re.findall(".{1,4}", body + check))
    elif kind == 3:
        a, b, c = number(3), number(3), number(4)
        s = rng.choice([f"+{rng.randint(1, 9)} ({a}) {b}-{c}", f"+{number(2)} {a} {b} {c}", f"+{number(2)}-{a}-{b}-{c}", f"({a}) {b}-{c}", f"00{number(2)} {a} {b} {c}"])
    elif kind == 4:
        s = rng.choice([f"{number(4)}-{number(2)}-{number(2)}", f"{number(1)}.{number(1)}.{number(2)}", number(rng.randint(1, 12)), f"{number(3)}.{number(3)},{number(2)}",
                        f"{number(4)}-{number(2)}-{number(2)} {number(2)}:{number(2)}:{number(2)}", f"{word(4)}={number(9)}", f"@{word(6)}"])
    elif kind == 5:
        s = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([16, 32, 40])))
    else:
        s = ".".join(str(rng.randint(256, 999)) for _ in range(4)) if rng.random() < 0.5 else number(rng.choice([14, 16, 17, 20, 25]))
        kind = 2 if 14 <= len(s) <= 19 and "." not in s and luhn(s) else kind
    left, right = rng.choice(["", "", f"{word(5)} ", "("]), rng.choice(["", "", ".", ",", ")", f" {word(5)}"])
    return left + s + right, [(len(left), len(left) + len(s), kind)] if kind < 4 else []


def train(examples: list[tuple[str, list[Span]]], seed: int = SEED) -> Weights:
    """Weights from (region, its spans) and the generator's examples."""
    rng = random.Random(seed)
    cases = []
    for text, spans in [*examples, *(_made(rng) for _ in range(700))]:
        cuts, segments = _segments(text)
        place = {c: i for i, c in enumerate(cuts)}
        gold = {(place.get(a, -1), place.get(b, -1), k) for a, b, k in spans}
        if segments and gold <= {(i, j, k) for i, j, _ in segments for k in range(len(KINDS))}:
            cases.append((len(cuts) - 1, segments, gold))
    weights: Weights = {}
    for epoch in range(EPOCHS):
        rng.shuffle(cases)
        for n, segments, gold in cases:
            _gradient(weights, n, segments, gold, RATE / (1 + epoch))
    return weights


def spans_of(weights: Weights, text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    if not _CUE.search(text):
        return [], []
    base = base_spans(text)
    more = []
    for a, b in regions(text):
        for s, e, k in decode(weights, text[a:b]):
            if not any(a + s < y and x < a + e for x, y, _ in _touching(base, a, b)):
                more.append((a + s, a + e, k))
    return base, sorted([*base, *more], key=lambda s: (s[0], s[2]))


def _touching(spans: list[Span], a: int, b: int) -> list[Span]:
    from bisect import bisect_left

    # base spans of one kind don't overlap, so few begin before ``a`` and reach into it
    hi = bisect_left(spans, (b,))
    lo = bisect_left(spans, (a,))
    while lo > 0 and any(y > a for _, y, _ in spans[max(0, lo - len(KINDS)) : lo]):
        lo -= 1
    return spans[lo:hi]


def _regions_of_rows(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows, marks = [], []
        for text in batch:
            found, spans = [], []
            base = base_spans(text or "")
            for a, b in regions(text or ""):
                if len(found) == PER_DOCUMENT:
                    break
                if b - a > 400 or _DISGUISE.search(text, a, b):  # the rules can't label a disguise; the generator has them
                    continue
                found.append(text[a:b])
                spans.append(" ".join(f"{x - a}:{y - a}:{k}" for x, y, k in base if a <= x and y <= b))
            rows.append(found)
            marks.append(spans)
        yield pd.DataFrame({"regions": rows, "spans": marks})


def corpus_examples(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[str, list[Span]]]:
    """Regions of at most ``sample`` documents that have any, with what the rules find there; a few KB a document."""
    arrow_batches(docs.sparkSession)
    of = F.pandas_udf(_regions_of_rows, StructType([StructField("regions", ArrayType(StringType())), StructField("spans", ArrayType(StringType()))]))
    ids = docs.select("doc_id", F.md5("text").alias("m")).where(F.col("text").rlike("[0-9@]")).groupBy("m").agg(F.min("doc_id").alias("doc_id"))
    chosen = ids.orderBy("m").limit(sample).select("doc_id").distinct()
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # ``sample`` ids
    rows = texts.select(of(F.col("text")).alias("f")).select("f.*").limit(4 * sample).collect()
    pairs = sorted((r, s) for row in rows for r, s in zip(row["regions"], row["spans"]))
    return [(r, [tuple(map(int, x.split(":"))) for x in s.split()]) for r, s in pairs]


def _found(weights: Weights):
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            pairs = [spans_of(weights, t or "") for t in batch]
            show = lambda spans: [f"{KINDS[k]}:{a}:{b}" for a, b, k in spans]
            yield pd.DataFrame({"base": [show(x) for x, _ in pairs], "spans": [show(y) for _, y in pairs]})

    return F.pandas_udf(run, StructType([StructField("base", ArrayType(StringType())), StructField("spans", ArrayType(StringType()))]))


def find(docs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``docs`` with ``pii``: base and spans, each an array of kind:start:end."""
    arrow_batches(docs.sparkSession)
    weights = train(corpus_examples(docs)) if weights is None else weights
    return docs.withColumn("pii", _found(weights)(F.col("text")))


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by the name of its first kind."""
    out, last = [], 0
    for a, b, k in spans:
        if a >= last:
            out += [text[last:a], f"[{KINDS[k].upper()}]"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def redacted(docs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; ``n_chars``, where there is one, follows the text."""
    arrow_batches(docs.sparkSession)
    weights = train(corpus_examples(docs)) if weights is None else weights

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([None if t is None else mask(t, spans_of(weights, t)[1]) for t in batch], dtype=object)

    out = docs.withColumn("text", F.pandas_udf(run, StringType())(F.col("text")))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
