"""Personal data by bootstrapped contextual extraction.

1. *Seeds.*  Fixed rules find emails, IP addresses, card and phone numbers.
   Other words that look like identifiers (an at sign or three digits, at
   least five characters) are candidates of unknown kind.
2. *Patterns.*  Every seed and candidate induces lexical patterns from its
   context: the two words before it, the word before it with its own shape
   (letters ``a``, digits ``9``, runs as one), and for card and phone numbers
   the form alone (every digit as ``9``).  Numbers side by side fail the rules
   together: all parts of them that pass a rule alone are candidates by form.
3. *Scores.*  Patterns and instances (identifier strings) form a graph.  In
   each round a pattern's support for a kind is the sum of the scores of its
   distinct instances, and its confidence that support's share of all
   supports plus ``UNKNOWN_WEIGHT`` for each instance without a score: what is
   unknown speaks against a pattern less than what is known to be of another
   kind, but a pattern around which most is unknown is not trusted.  An unknown
   instance takes the best confidence of its patterns that reach
   ``MIN_CONFIDENCE`` with ``MIN_SUPPORT`` instances behind them.  Rounds are
   joins and aggregations in Spark.
4. *Discovery.*  Occurrences of unknown instances in a pattern of high
   confidence are added as spans of its kind; of parts that overlap, the
   longest.  The seeds always stay.
"""

from __future__ import annotations

import bisect
import itertools
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.llm import common as C
from ripplekit.plans.lineage import materialize

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_CONFIDENCE = 0.9
MIN_SUPPORT = 5.0
UNKNOWN_WEIGHT = 0.25
LONG = 64   # characters of a word or identifier above which its hash stands for it

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A start inside a run of digits matches no better than the start of the run.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_CANDIDATE = re.compile(r"[^\s,;|\"'<>()\[\]]*[0-9@][^\s,;|\"'<>()\[\]]*")
_WORD = re.compile(r"[^\W_]+")


def _luhn(digits: list[int]) -> bool:
    total = sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str):
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            free = m.end()
            yield start, free
        at = text.find("@", max(free, at + 1))


def _is_card(match: str) -> bool:
    digits = [int(c) for c in match if c not in " -"]
    return 12 <= len(digits) <= 19 and _luhn(digits)


def _is_phone(match: str) -> bool:
    return 9 <= sum(c.isdigit() for c in match) <= 15


_CHECKS = {2: (_CARD, _is_card), 3: (_PHONE, _is_phone)}
_MOST_DIGITS = {2: 19, 3: 15}   # that the checks let pass


def base_spans(text: str, failed: list | None = None) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the seeds, sorted; code points, end
    exclusive.  ``failed`` takes the places of card and phone matches that
    did not pass their checks."""
    out = [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for kind, (rule, check) in _CHECKS.items():
            for m in rule.finditer(text):
                if m.end() - m.start() >= 9:
                    if check(m.group()):
                        out.append((m.start(), kind, m.end()))
                    elif failed is not None:
                        failed.append((m.start(), m.end()))
    return sorted(out)


def _form(value: str) -> str:
    """Digits as 9, letters as a."""
    return "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in value)


def _name(value: str) -> str:
    """What stands for a word, form or identifier in the graph: all of it, or
    128 bits of hash and its length if it is long."""
    return value if len(value) <= LONG else f"#{len(value)}-{xxhash.xxh3_128_hexdigest(value.encode())}"


def shape(value: str) -> str:
    return re.sub(r"a+", "a", re.sub(r"9+", "9", _form(value)))


def _inside(text: str, lo: int, hi: int):
    """All runs of words of a failed match that pass the check of a kind by
    themselves: ``start, kind, end``.  Numbers that stand side by side make
    one match, which fails.  A run ends where its digits exceed what the kind
    can have; every word of a card has a digit, and a phone number starts with
    the plus that only the first word of a match has."""
    words = [(lo + m.start(), lo + m.end()) for m in re.finditer(r"[^ ]+", text[lo:hi])]
    digits = [sum(c.isdigit() for c in text[s:e]) for s, e in words]
    for kind, (rule, check) in _CHECKS.items():
        for i in range(1 if kind == 3 else len(words)):
            s, n = words[i][0], 0
            if kind == 3 and text[s] != "+":
                break
            for j in range(i, len(words)):
                n, e = n + digits[j], words[j][1]
                if n > _MOST_DIGITS[kind] or kind == 2 and not digits[j]:
                    break
                if n >= 9 and digits[j] and rule.fullmatch(text, s, e) and check(text[s:e]):
                    yield s, kind, e


def longest(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of ``(start, kind, end)`` that may overlap, those apart from each other
    that cover most, the longer ones if several do; and any other that covers
    a word that these do not."""
    spans = sorted(set(spans), key=lambda x: (x[2], x[0], x[1]))
    ends = [x[2] for x in spans]
    best: list[tuple[int, int]] = [(0, 0)]      # covered, minus the number of spans
    before = []
    for n, (s, _, e) in enumerate(spans):
        before.append(bisect.bisect_right(ends, s, 0, n))
        c, m = best[before[n]]
        best.append(max(best[n], (c + e - s, m - 1)))
    out, n = [], len(spans)
    while n:
        if best[n] == best[n - 1]:
            n -= 1
        else:
            out.append(spans[n - 1])
            n = before[n - 1]
    out.reverse()
    starts, stops, chosen = [x[0] for x in out], [x[2] for x in out], set(out)
    for x in spans:
        at, k = x[0], bisect.bisect_right(stops, x[0])
        # Two characters between whole words are blanks.
        while x not in chosen and k < len(out) and starts[k] - at <= 2 and at < x[2]:
            at, k = stops[k], k + 1
        if x not in chosen and x[2] - at > 2:
            out.append(x)
    return sorted(out)


class _Words:
    """The words of a text (runs of letters and digits), found when first
    asked for."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, None, None

    def before(self, at: int) -> list[str]:
        """The two words before a place, '' where there is none; of a word that
        goes on there the part before it."""
        if self.starts is None:
            spans = [m.span() for m in _WORD.finditer(self.text)]
            self.starts, self.ends = [x[0] for x in spans], [x[1] for x in spans]
        n = bisect.bisect_left(self.starts, at)
        near = [_name(self.text[self.starts[i]:min(self.ends[i], at)].lower()) for i in range(max(0, n - 2), n)]
        return [""] * (2 - len(near)) + near


def _context(words: _Words, start: int, value: str, kind: int) -> list[str]:
    if kind in _CHECKS:
        own = [f"f {KINDS[kind]} {_name(_form(value))}"]
    else:
        own = []
    before = words.before(start)
    return ["w " + " ".join(before), "s " + before[1] + " " + _name(shape(value)), *own]


def mentions(text: str) -> tuple[list, list]:
    """Seeds, and every seed and candidate with its kind (-1: unknown),
    instance and patterns."""
    failed: list[tuple[int, int]] = []
    base, words = base_spans(text, failed), _Words(text)
    found = [(s, k, e, _context(words, s, text[s:e], k)) for s, k, e in base]
    starts = [a for a, _, _ in base]
    reached = [0, *itertools.accumulate((z for _, _, z in base), max)]
    for s, k, e in {x for region in failed for x in _inside(text, *region)}:
        if reached[bisect.bisect_left(starts, e)] <= s:
            found.append((s, -1, e, [f"f {KINDS[k]} {_name(_form(text[s:e]))}"]))
    if base or "@" in text or _DIGIT.search(text):
        i, reach = 0, 0
        for m in _CANDIDATE.finditer(text):
            s, e = m.start(), m.end()
            while e > s and text[e - 1] in ".:!?-":
                e -= 1
            while i < len(base) and base[i][0] < e:
                reach = max(reach, base[i][2])
                i += 1
            if e - s < 5 or reach > s:
                continue
            v = text[s:e]
            if "@" in v or sum(c.isdigit() for c in v) >= 3:
                found.append((s, -1, e, _context(words, s, v, -1)))
    return base, [(s, k, e, _name(text[s:e].lower()), pats) for s, k, e, pats in found]


_SPAN = "struct<start:int,kind:int,end:int>"
_FOUND = f"doc_id long, text_hash long, base array<{_SPAN}>, found array<struct<start:int,kind:int,end:int,inst:string,pats:array<string>>>"
_P_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_P_FOUND = pa.struct([*_P_SPAN, pa.field("inst", pa.string()), pa.field("pats", pa.list_(pa.string()))])


def _extract(batches):
    for b in batches:
        base, found = [], []
        for text in b.column("text").to_pylist():
            x, y = mentions(text)
            base.append([dict(zip(("start", "kind", "end"), t)) for t in x])
            found.append([dict(zip(("start", "kind", "end", "inst", "pats"), t)) for t in y])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("text_hash"), pa.array(base, pa.list_(_P_SPAN)),
             pa.array(found, pa.list_(_P_FOUND))], names=["doc_id", "text_hash", "base", "found"])


def _longest(added: Column) -> Column:
    @F.arrow_udf(f"array<{_SPAN}>")
    def cut(spans: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(("start", "kind", "end"), x)) for x in longest(
            [(y["start"], y["kind"], y["end"]) for y in row])] for row in spans.to_pylist()], pa.list_(_P_SPAN))
    return cut(added)


def score_patterns(found: DataFrame, rounds: int = ROUNDS, min_confidence: float = MIN_CONFIDENCE,
                   min_support: float = MIN_SUPPORT, unknown_weight: float = UNKNOWN_WEIGHT) -> DataFrame:
    """``pat, kind, confidence, support, n`` of the patterns of high
    confidence, from ``found(kind, inst, pats)``; ``n``: distinct instances."""
    edges = materialize(found.select(F.explode("pats").alias("pat"), "inst", "kind").distinct(), "pii-edges")
    size = materialize(edges.groupBy("pat").agg(F.countDistinct("inst").alias("n"))
                       .where(F.col("n") >= min_support), "pii-patterns")
    seeds = edges.where("kind >= 0").select("inst", "kind").distinct().withColumn("score", F.lit(1.0))
    unknown = edges.where("kind = -1").select("pat", "inst") \
        .join(seeds.select("inst").distinct(), "inst", "left_anti")
    # Written, so that a very common instance or pattern can be split in joins.
    links = materialize(edges.select("pat", "inst").distinct(), "pii-links")
    unknown = materialize(unknown, "pii-unknown")
    scores, good = seeds, None
    for r in range(rounds):
        # An instance of several kinds or of a score below one counts as known in part.
        known = scores.groupBy("inst").agg(F.least(F.sum("score"), F.lit(1.0)).alias("known"))
        supports = links.join(scores, "inst").groupBy("pat", "kind").agg(F.sum("score").alias("support"))
        total = supports.groupBy("pat").agg(F.sum("support").alias("total")) \
            .join(links.join(known, "inst").groupBy("pat").agg(F.sum("known").alias("known")), "pat")
        against = F.col("total") + unknown_weight * (F.col("n") - F.col("known"))
        good = materialize(
            supports.join(size, "pat").join(total, "pat")
            .select("pat", "kind", (F.col("support") / against).alias("confidence"), "support", "n")
            .where((F.col("confidence") >= min_confidence) & (F.col("support") >= min_support)), "pii-good")
        if r + 1 < rounds:
            scores = materialize(seeds.unionByName(
                unknown.join(good, "pat").groupBy("inst", "kind").agg(F.max("confidence").alias("score"))),
                "pii-scores")
    return good


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, base, spans``: arrays of ``start, kind, end``
    (kind: place in :data:`KINDS`) sorted by start and kind; ``spans`` holds
    the seeds and what the patterns add.

    A null text is empty and has no spans; rows without an id are left out;
    rows that share an id are told apart by ``text_hash``
    (``common.text_hash``); other columns are not read."""
    texts = C.id_and_text(docs, id_col, text_col).withColumn("text_hash", C.text_hash())
    rows = materialize(texts.mapInArrow(_extract, _FOUND), "pii-mentions")
    key = ["doc_id", "text_hash"]
    found = rows.select(*key, F.explode("found").alias("f")).select(*key, "f.*")
    good = score_patterns(found).select("pat", "kind", "confidence")
    added = (found.where("kind = -1").select(*key, "start", "end", F.explode("pats").alias("pat"))
             .join(good, "pat").groupBy(*key, "start", "end")
             .agg(F.min_by("kind", F.struct(-F.col("confidence"), F.col("kind"))).alias("kind")))
    per_doc = added.groupBy(*key).agg(F.collect_list(F.struct(
        F.col("start"), F.col("kind"), F.col("end"))).alias("added")) \
        .select(*key, _longest(F.col("added")).alias("added"))
    none = F.array().cast(f"array<{_SPAN}>")
    return rows.select(*key, "base").join(per_doc, key, "left").select(
        *key, "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def _redact(text: str, spans: list) -> str:
    out, at = [], 0
    for s in spans:
        if s["end"] > at:
            out += [text[at:max(at, s["start"])], f"[{KINDS[s['kind']].upper()}]" if s["start"] >= at else ""]
            at = s["end"]
    return "".join([*out, text[at:]])


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; a span that
    overlaps the one before it goes with that one."""
    @F.arrow_udf("string")
    def cut(t: pa.Array, s: pa.Array) -> pa.Array:
        return pa.array([x if x is None or not y else _redact(x, y)
                         for x, y in zip(t.to_pylist(), s.to_pylist())], pa.string())
    return cut(text, spans)
