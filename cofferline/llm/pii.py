"""Personal data: fixed patterns, and a semi-Markov conditional random field that finds variants.

The patterns give the base spans. Around digits, ``@`` and their spoken or bracketed forms the text is
cut into atoms; a segment is up to ``_LONGEST`` atoms with one type, scored by features of the whole span. Dynamic programming over
boundaries and types together gives the best segmentation. The field is trained on a bounded sample
of base spans and of variants made from them, by gradient steps on the exact likelihood.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofferline.llm.common import values_of

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits fails or fits as a whole, so no attempt begins inside one
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")

_LONGEST = 16
#: Bounds of the fit: regions that are used.
MAX_REGIONS = 800
_MAX_ATOMS = 80
_EPOCHS = 8
_RATE = 0.3
_SHRINK = 1e-4

SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


# -- base spans -------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            done = domain.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind, then start."""
    out = [("email", *span) for span in emails(text)]
    if _SIGN.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(_small(part) for part in m[0].split("."))]
        for m in _CARD.finditer(text):
            number = _digits(m[0])
            if 13 <= len(number) <= 19 and luhn(number):
                out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def _small(part: str) -> bool:
    bare = part.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


# -- the field --------------------------------------------------------------------------------

_ATOM = re.compile(r"[A-Za-z\u0080-\U0010ffff]+|[0-9]+|[^\sA-Za-z0-9\u0080-\U0010ffff]")
_LETTER = r"[A-Za-z\u0080-\U0010ffff]"
_STEP = re.compile(
    rf"[0-9@]\S*|(?<!{_LETTER})(?:[Aa][Tt]|[Dd][Oo][Tt])(?!{_LETTER})\S*|[\[({{<]\.[\])}}>]\S*|(?<!\S)\.(?!\S)"
)
#: Two plain words with nothing but white space between them, and the beginning of a further label.
_LOOSE = re.compile(rf"(?<!{_LETTER})(?!at\s|dot\s)(?={_LETTER}+\s+(?!(?:at|dot)(?!{_LETTER})){_LETTER})", re.I)
_MORE = re.compile(rf"\.{_LETTER}|\s*[\[({{<]?\s*(?:\.|dot)\s*[\])}}>]\s*[A-Za-z0-9]|\s+(?:dot|\.)\s+[A-Za-z0-9]", re.I)
_DOT_WORD = re.compile(rf"(?<!{_LETTER})dot(?!{_LETTER})", re.I)
_AT_WORD = re.compile(rf"(?<!{_LETTER})at(?!{_LETTER})", re.I)
#: The word at, and names joined by points after it: ``[at] example.com``, ``(at) example[.]com``.
_TAIL = re.compile(
    rf"(?<!{_LETTER})at(?!{_LETTER})[\s\])}}>]*"
    rf"(?:[A-Za-z0-9\u0080-\U0010ffff-]+(?:\.|\s*[\[({{<]\s*\.\s*[\])}}>]\s*|\s+\.\s+))+{_LETTER}",
    re.I,
)
_CUES = frozenset("tel phone call mobile fax cell mail email card visa ip host address".split())


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around digits, ``@``, the words at and dot, and points in brackets or by themselves: three
    words before and after, joined where they meet. Those that can't hold personal data are left out."""
    out: list[tuple[int, int]] = []
    at = 0
    while found := _STEP.search(text, at):
        start, end = found.span()
        for _ in range(4):
            while start > at and not text[start - 1].isspace():
                start -= 1
            while start > at and text[start - 1].isspace():
                start -= 1
        for _ in range(3):
            while end < len(text) and text[end].isspace():
                end += 1
            while end < len(text) and not text[end].isspace():
                end += 1
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        at = end
    return [(start, end) for start, end in out if _possible(text[start:end])]


def _spoken(span: str) -> bool:
    """Whether a span has the word at, and the word dot or a domain after it."""
    return bool(_AT_WORD.search(span) and (_DOT_WORD.search(span) or _TAIL.search(span)))


def _possible(region: str) -> bool:
    """False only where no span of the region has features."""
    return bool(_SIGN.search(region)) or _spoken(region)


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n > edge for edge in edges)


def span_features(text: str, atoms: list[tuple[int, int]], first: int, end: int) -> list[str]:
    """Features of the span from atom ``first`` up to ``end``; none if it can't be personal data."""
    start, stop = atoms[first][0], atoms[end - 1][1]
    span = text[start:stop]
    head, last = span[0], span[-1]
    if "\n" in span or not (head.isalnum() or head in "+(") or not last.isalnum():
        return []
    digits = _digits(span)
    words = [text[a:b].lower() for a, b in atoms[first:end] if text[a].isalpha()]
    spoken = "at" in words and text[atoms[first][0] : atoms[first][1]].lower() != "at"
    spoken = spoken and ("dot" in words[words.index("at") + 1 :] or bool(_TAIL.search(span)))
    groups = [text[a:b] for a, b in atoms[first:end] if text[a] in "0123456789"]
    four = len(groups) == 4 and not words
    if len(digits) < 7 and "@" not in span and not spoken and not four:
        return []
    before = text[start - 1] if start else " "
    after = text[stop] if stop < len(text) else " "
    marks = "".join(sorted({c for c in span if not c.isalnum()}))
    out = [
        "bias",
        f"digits{_bucket(len(digits), (0, 3, 6, 7, 8, 9, 10, 11, 12, 15, 16, 19))}",
        f"length{_bucket(stop - start, (6, 9, 12, 15, 17, 20, 30, 45))}",
        f"atoms{end - first}",
        f"marks{marks}",
        f"words{min(len(words), 6)}",
        f"ats{min(span.count('@') + words.count('at'), 2)}",
        f"edges{before.isalnum() or before in '@._+-'}{after.isalnum() or after in '@_-'}",
        f"head{head if head in '+(' else 'a' if head.isalpha() else '0'}",
        f"last{'a' if last.isalpha() else '0'}",
        f"lines{after == '.' or after.isspace()}",
    ]
    if not words:
        out.append("groups" + "-".join(str(len(group)) for group in groups[:6]))
        if 13 <= len(digits) <= 19:
            out.append(f"luhn{luhn(digits)}")
        if four and "." in marks:
            out.append(f"octets{all(map(_small, groups))}")
    else:
        out += [f"loose{min(len(_LOOSE.findall(span)), 2)}", f"more{bool(_MORE.match(text, stop))}"]
        out += [f"spoken{spoken}", f"final{_bucket(len(words[-1]), (1, 3, 6))}", f"firstword{words[0] in _CUES}"]
    if first and text[atoms[first - 1][0] : atoms[first - 1][1]].lower() in _CUES:
        out.append("cue")
    return out


def _segments(text: str) -> tuple[list[tuple[int, int]], list[list[tuple[int, list[str]]]]]:
    """Atoms, and for every end the segments that could be personal data: (first atom, features)."""
    atoms = [m.span() for m in _ATOM.finditer(text)]
    ending: list[list[tuple[int, list[str]]]] = [[] for _ in range(len(atoms) + 1)]
    for end in range(1, len(atoms) + 1):
        for first in range(max(0, end - _LONGEST), end):
            features = span_features(text, atoms, first, end)
            if features:
                ending[end].append((first, features))
    return atoms, ending


def _scores(features: list[str], weights: dict) -> list[float]:
    totals = [0.0] * len(KINDS)
    for name in features:
        own = weights.get(name)
        if own:
            for k, value in enumerate(own):
                totals[k] += value
    return totals


def decode(text: str, weights: dict) -> list[tuple[str, int, int]]:
    """The best segmentation's personal data. One atom outside scores 0."""
    atoms, ending = _segments(text)
    best, back = [0.0] * (len(atoms) + 1), [(0, -1)] * (len(atoms) + 1)
    for end in range(1, len(atoms) + 1):
        best[end], back[end] = best[end - 1], (end - 1, -1)
        for first, features in ending[end]:
            for kind, score in enumerate(_scores(features, weights)):
                if best[first] + score > best[end]:
                    best[end], back[end] = best[first] + score, (first, kind)
    out, end = [], len(atoms)
    while end:
        first, kind = back[end]
        if kind >= 0:
            out.append((KINDS[kind], atoms[first][0], atoms[end - 1][1]))
        end = first
    return out[::-1]


def _log_add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def train(cases: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = _EPOCHS) -> dict:
    """Weights by feature, one per kind, from texts with their true spans."""
    weights: dict[str, list[float]] = defaultdict(lambda: [0.0] * len(KINDS))
    prepared = []
    for text, spans in cases:
        atoms, ending = _segments(text)
        if len(atoms) <= _MAX_ATOMS:
            places = {(start, stop): KINDS.index(kind) for kind, start, stop in spans}
            gold = {
                (first, end): places[atoms[first][0], atoms[end - 1][1]]
                for end, own in enumerate(ending)
                for first, _ in own
                if (atoms[first][0], atoms[end - 1][1]) in places
            }
            prepared.append((len(atoms), ending, gold))
    order = random.Random(7)
    for epoch in range(epochs):
        order.shuffle(prepared)
        rate = _RATE / (1 + epoch)
        for n, ending, gold in prepared:
            scored = [[(first, features, _scores(features, weights)) for first, features in own] for own in ending]
            ahead = [0.0] * (n + 1)
            for end in range(1, n + 1):
                ahead[end] = ahead[end - 1]
                for first, _, scores in scored[end]:
                    for score in scores:
                        ahead[end] = _log_add(ahead[end], ahead[first] + score)
            behind = [0.0] * (n + 1)
            starting: list[list] = [[] for _ in range(n + 1)]
            for end, own in enumerate(scored):
                for first, _, scores in own:
                    starting[first].append((end, scores))
            for first in range(n - 1, -1, -1):
                behind[first] = behind[first + 1]
                for end, scores in starting[first]:
                    for score in scores:
                        behind[first] = _log_add(behind[first], behind[end] + score)
            for end, own in enumerate(scored):
                for first, features, scores in own:
                    for kind, score in enumerate(scores):
                        share = math.exp(min(0.0, ahead[first] + score + behind[end] - ahead[n]))
                        change = rate * ((gold.get((first, end)) == kind) - share)
                        if abs(change) > 1e-6:
                            for name in features:
                                own_weights = weights[name]
                                own_weights[kind] += change - rate * _SHRINK * own_weights[kind]
    return {name: own for name, own in weights.items() if any(own)}


def _written(name: str, host: str, draw: random.Random) -> str:
    """An e-mail address in one of the forms that the fixed pattern doesn't fit."""
    return draw.choice([f"{name} at {host.replace('.', ' dot ')}", f"{name} [at] {host}", f"{name}(at){host}", f"{name} @ {host}"])


def _put(text: str, spans: list[tuple[str, int, int]], old: tuple[str, int, int], new: str, keep: bool = True):
    """The case with ``new`` in place of one span; the span stays marked if ``keep``."""
    kind, start, end = old
    shift = len(new) - (end - start)
    moved = [(k, a + shift * (a >= end), b + shift * (a >= end)) for k, a, b in spans if b <= start or a >= end]
    return text[:start] + new + text[end:], moved + [(kind, start, start + len(new))] * keep


def _variants(text: str, spans: list[tuple[str, int, int]], draw: random.Random) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The case itself, and forms of it that people write as well or that only look alike."""
    out = [(text, spans)]
    for kind, start, end in spans:
        old, keep = text[start:end], True
        if kind == "email":
            name, _, host = old.rpartition("@")
            new = _written(name, host, draw)
            # the same with a plain name and a short host
            short = _written(re.split(r"[._%+-]", name)[0] or name, ".".join(host.split(".")[-2:]), draw)
            out.append(_put(text, spans, (kind, start, end), short))
        elif kind == "phone":
            bare = _digits(old)
            ten = bare[-10:]
            new = draw.choice(
                [old.lstrip("+"), f"({ten[:3]}) {ten[3:6]}-{ten[6:]}", f"{ten[:3]}-{ten[3:6]}-{ten[6:]}", f"{ten[:3]}.{ten[3:6]}.{ten[6:]}", f"00{bare[:2]} {bare[2:]}"]
            )
        elif kind == "card":
            bare = _digits(old)
            wrong = bare[:-1] + str((int(bare[-1]) + 1 + draw.randrange(9)) % 10)
            others = [s for s in spans if s[2] <= start]
            out.append((text[:start] + wrong, others))
            new = draw.choice([".", "/", "  "]).join(bare[i : i + 4] for i in range(0, len(bare), 4))
        elif draw.random() < 0.5:
            parts = old.split(".")
            new, keep = ".".join([*parts[:3], str(300 + draw.randrange(600))]), False
        else:
            new = old.replace(".", draw.choice([" . ", "[.]", "(.)"]))
        out.append(_put(text, spans, (kind, start, end), new, keep))
    return out


def _training_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text in values_of(batch.column(0)):
            if text:
                found += [text[a:b] for a, b in regions(text) if b - a < 8 * _MAX_ATOMS]
        yield pa.RecordBatch.from_pydict({"region": pa.array(found, pa.string())})


def fit(docs: DataFrame, text: str = "text", max_regions: int = MAX_REGIONS) -> dict:
    """Train on at most ``max_regions`` distinct stretches of the documents, chosen by a hash.

    Half of them hold a base span where there are enough. An empty table gives no weights, and then
    nothing is found beyond the base spans."""
    stretches = docs.select(text).mapInArrow(_training_regions, "region string").distinct()
    holds = F.rlike(F.col("region"), F.lit(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.|\+[0-9]|[0-9]{13}|[0-9]+\.[0-9]+\.[0-9]+\.[0-9]")).cast("int")
    rows = (
        stretches.withColumn("holds", holds)
        .orderBy(F.desc("holds"), F.xxhash64("region"), "region")
        .limit(max_regions // 2)
        .unionByName(stretches.withColumn("holds", holds).orderBy("holds", F.xxhash64("region"), "region").limit(max_regions // 4))
        .collect()
    )
    draw = random.Random(11)
    cases = []
    for region in sorted({row.region for row in rows}):
        spans = base_spans(region)
        spans = [s for s in spans if not any(o is not s and o[1] <= s[1] and s[2] <= o[2] for o in spans)]
        cases += _variants(region, spans, draw)
    return train(cases)


# -- operator ---------------------------------------------------------------------------------


def find_in_text(text: str | None, weights: dict | None) -> list[tuple[str, int, int, bool]]:
    """All spans by kind, then start; base spans stay, added ones never overlap them."""
    if not text:
        return []
    out = [(*span, True) for span in base_spans(text)]
    if weights:
        fixed = sorted((start, end) for _, start, end, _ in out)
        starts = [start for start, _ in fixed]
        reached = list(accumulate((end for _, end in fixed), max, initial=0))
        for first, last in regions(text):
            for kind, start, end in decode(text[first:last], weights):
                a, b = first + start, first + end
                # none of the base spans that begin before its end reaches behind its start
                if reached[bisect_left(starts, b)] <= a:
                    out.append((kind, a, b, False))
        out.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
    return out


def _finder(shared):
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = shared.value
        for texts in batches:
            rows = []
            for text in values_of(texts):
                spans = find_in_text(text, weights)
                rows.append([{"kind": k, "start": a, "end": b, "base": own} for k, a, b, own in spans])
            yield pa.array(rows, _ARROW)

    return find


def find_pii(docs: DataFrame, weights: dict | None, text: str = "text", spans: str = "spans") -> DataFrame:
    """Add ``spans``: kind, start and end (code points, end exclusive), and whether a fixed pattern found it.

    ``weights`` are those of ``fit``; None leaves the field out. Null and empty texts have no spans.
    A column of that name is replaced. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    return docs.withColumn(spans, F.arrow_udf(_finder(shared), SPANS)(F.col(text)))


def redact(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Put ``[KIND]`` in place of every span of ``text``; overlapping spans become one, named by the first."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind"))))
    merged = F.aggregate(
        ordered,
        F.array().cast("array<struct<start:int,end:int,kind:string>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] > s["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                        F.element_at(done, -1)["kind"].alias("kind"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    built = F.aggregate(
        merged,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda state, s: F.struct(
            F.concat(
                state["out"],
                F.col(text).substr(state["at"] + 1, s["start"] - state["at"]),
                F.lit("["),
                F.upper(s["kind"]),
                F.lit("]"),
            ).alias("out"),
            s["end"].alias("at"),
        ),
        lambda state: F.concat(state["out"], F.col(text).substr(state["at"] + 1, F.lit(2**31 - 1))),
    )
    return df.withColumn(text, F.when(F.size(spans) > 0, built).otherwise(F.col(text)))
