"""Operator 2: secret scans, fixed patterns plus password guess-cost over values in credential context."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

KINDS = ("assign", "access", "hex", "guess")
_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # a maximal run of 32 or more: the leftmost match starts where the run does
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Wider credential contexts, whose values are judged by guess cost. A keyword starts a word, or a part of one after a sign, `_`
#: or a change from a lower-case letter or digit to upper case (DB_PWD, db-pass, dbPwd).
#: Names of accounts take a sign before their value; after the others `is` will do, unless what follows is letters alone, which is prose.
_CONTEXT = re.compile(
    r"""(?ai)(?:(?<![a-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])))(?:(?:log[_-]?in|user(?:name)?)\b["']?\x20{0,3}(?:[:=]|=>)|(?:pwd|pass(?:word|wd|code|phrase)?|pin|secret|token|api[_-]?key|access[_-]?key|"""
    r"""private[_-]?key|client[_-]?secret|credentials?|auth(?:orization)?|bearer)\b["']?\x20{0,3}(?:[:=]|=>|(\bis\b)))\x20{0,3}"""
    r"""(?:bearer\x20)?["']?([^\s"',;<>]{6,})"""
)
_CONTEXT_WORDS = ("login", "log_in", "log-in", "user", "pwd", "pass", "pin", "secret", "token", "key", "credential", "auth", "bearer")
#: Frequent password words, most frequent first (a rank is its guess count).
COMMON_WORDS = (
    "password", "admin", "welcome", "letmein", "dragon", "master", "monkey", "login", "princess", "sunshine", "shadow",
    "football", "baseball", "superman", "batman", "trustno", "hello", "secret", "test", "user", "guest", "root", "default",
    "changeme", "example", "sample", "demo", "pass", "love", "summer", "winter", "spring", "autumn", "the", "and", "for",
    "you", "server", "system", "access", "public", "private", "account", "office", "computer", "internet", "mail", "data",
)
_RANK = {w: i + 1 for i, w in enumerate(COMMON_WORDS)}
#: Words of the corpus that join them: whole words of so many letters.
_SHORTEST, _LONGEST = 3, 24
_EDGES = "\"'`()[]{}<>.,;:!?¡¿„“”‘’«»…"
#: Rows of a keyboard, each a half key to the right of the one above it or less, and runs of the alphabet and of digits.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
SEQUENCES = ("abcdefghijklmnopqrstuvwxyz", "0123456789")


def _moves() -> tuple[dict[str, int], dict[str, int]]:
    """The direction, by number, of each step from a key to a neighbouring one: along a row, or to the row above or below."""
    place = {c: (r, i) for r, row in enumerate(KEYBOARD) for i, c in enumerate(row)}
    ways = {(0, 1): 0, (0, -1): 1, (1, 0): 2, (1, -1): 3, (-1, 0): 4, (-1, 1): 5}
    near = {(a, b): (place[b][0] - place[a][0], place[b][1] - place[a][1]) for a in place for b in place}
    out = {a + b: ways[step] for (a, b), step in near.items() if step in ways}
    # steps of a sequence have directions of their own, so that a walk doesn't mix the two
    return out, {a + b: k for row in SEQUENCES for k, r in enumerate((row, row[::-1])) for a, b in zip(r, r[1:])}


_KEYS, _STEPS = _moves()
_D = r"[-/.]?"
#: Dates by their numbers of digits, so that every length at a place is found: a year, day and month before it, or after it.
_YEAR = re.compile(r"(?:19|20)\d\d")
_DATES = [re.compile(p, re.ASCII) for a in (1, 2) for b in (1, 2) for p in (
    rf"\d{{{a}}}{_D}\d{{{b}}}{_D}(?:19|20)\d\d", rf"(?:19|20)\d\d{_D}\d{{{a}}}{_D}\d{{{b}}}", rf"\d{{{a}}}[-/.]\d{{{b}}}[-/.]\d\d"
)]
_SWAPS = str.maketrans("@4310$5!7", "aaeiossit")
#: Segments of a walk are at most so long, repeated blocks at most so many characters.
_WALK, _BLOCK = 24, 8


def _alphabet(c: str) -> float:
    """log10 of the characters that a brute-force guess has to try in this one's place."""
    return math.log10(26 if c.islower() else 52 if c.isalpha() else 10 if c.isdigit() else 33)


class _Repeats:
    """Least cost of ending at i with a block of p characters repeated m times, over all m that the run before i allows.

    That is the least of best[i - m*p] + log10(m) over the starts of one residue class. Of two starts the earlier one gains on the later
    as i grows, and once ahead it stays ahead, so a stack of starts suffices, kept in the order in which they will be overtaken.
    """

    def __init__(self, p: int) -> None:
        self.p, self.same = p, 0
        self.stacks: list[list[int]] = [[] for _ in range(p)]

    def _overtaken(self, best: list[float], early: int, late: int) -> float:
        """From which i on the earlier start is the cheaper one; best[early] < best[late]."""
        gain = best[late] - best[early]
        ratio = 10.0 ** min(gain, 300.0)
        return math.inf if ratio <= 1.0 else (ratio * late - early) / (ratio - 1.0) if gain < 300.0 else late

    def least(self, value: str, best: list[float], i: int) -> float | None:
        """log10 of the cheapest start and count for a run that ends at i, without the block's own cost; None where nothing is repeated."""
        p = self.p
        if i <= p:
            return None
        self.same = self.same + 1 if value[i - 1] == value[i - 1 - p] else 0
        stack = self.stacks[i % p]
        count, fewest = self.same // p + 1, 3 if p == 1 else 2
        if count < fewest:
            stack.clear()
            return None
        new = i - fewest * p
        while stack and best[stack[-1]] >= best[new]:
            stack.pop()
        while len(stack) > 1 and self._overtaken(best, stack[-2], stack[-1]) <= self._overtaken(best, stack[-1], new):
            stack.pop()
        stack.append(new)
        cost = lambda j: best[j] + math.log10((i - j) // p)
        while len(stack) > 1 and cost(stack[-2]) <= cost(stack[-1]):
            stack.pop()
        return cost(stack[-1])


def guess_cost(value: str, ranks: Mapping[str, int] = _RANK) -> float:
    """log10 of the guesses that the cheapest segmentation of value needs.

    best[i] is the least cost of value[:i]; a segment ending at i is one of: a word of `ranks` (its rank + 1, twice that if not in
    lower case, four times for signs in place of letters); a date (130 years, times 365 with day and month); a block of at most
    _BLOCK characters repeated (the block's own cost times the count); a walk of three to _WALK keys (37 keys to start at, 6
    ways at each change of direction, its length); a stretch of the alphabet or of digits (36 starts, 2 ways, its length); or one
    brute-force character. Time is linear in len(value), runs of repeats included.
    """
    n, low = len(value), value.lower()
    if len(low) != n:  # a few letters grow when lowered
        low = value
    plain = low.translate(_SWAPS)
    best = [0.0] + [math.inf] * n
    dates: dict[int, list[tuple[int, float]]] = {}
    for i in range(n):
        if value[i].isdigit():
            for m in {m.end() for p in _DATES if (m := p.match(value, i))}:
                dates.setdefault(m, []).append((i, math.log10(365 * 130)))
            if m := _YEAR.match(value, i):
                dates.setdefault(m.end(), []).append((i, math.log10(130)))
    repeats = [_Repeats(p) for p in range(1, _BLOCK + 1)]
    blocks: dict[str, float] = {}
    for i in range(1, n + 1):
        cost = best[i - 1] + _alphabet(value[i - 1])
        for r in repeats:
            more = r.least(value, best, i)
            if more is not None:
                block = value[i - r.p : i]
                if block not in blocks:
                    blocks[block] = _alphabet(block) if r.p == 1 else guess_cost(block, ranks)
                cost = min(cost, more + blocks[block])
        turns, way, steps = 0, None, None
        key = run = True
        for j in range(i - 2, max(-1, i - 1 - _WALK), -1):
            pair = low[j : j + 2]
            now, step = _KEYS.get(pair), _STEPS.get(pair)
            turns, way = turns + (now != way), now
            key, run = key and now is not None, run and step is not None and steps in (None, step)
            steps = step
            if not key and not run:
                break
            if i - j >= 3:
                if key:
                    cost = min(cost, best[j] + math.log10(37 * 6**turns * (i - j)))
                if run:
                    cost = min(cost, best[j] + math.log10(36 * 2 * (i - j)))
        for j in range(max(0, i - _LONGEST), i - 2):
            rank = ranks.get(low[j:i]) or ranks.get(plain[j:i])
            if rank:
                extra = (math.log10(2) if value[j:i] != low[j:i] else 0) + (math.log10(4) if low[j:i] not in ranks else 0)
                cost = min(cost, best[j] + math.log10(rank + 1) + extra)
        best[i] = min(cost, *(best[j] + c for j, c in dates.get(i, ())), math.inf)
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, leftmost and non-overlapping a kind; code points."""
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def contexts(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, value) in credential context, apart from what base spans cover; code points."""
    low = text.lower()
    if not any(w in low for w in _CONTEXT_WORDS):
        return []
    out = []
    for m in _CONTEXT.finditer(text):
        s, e = m.span(2)
        prose = m[1] and m[2].strip(_EDGES).isalpha()
        if not prose and not any(a <= s and e <= b for a, _, b in base):
            out.append((s, e, m[2]))
    return out


def guess_spans(text: str, base: list[tuple[int, int, int]], least: float, ranks: Mapping[str, int] = _RANK) -> list[tuple[int, int, int]]:
    """Spans of credential-context values whose guess cost is at least 10**least, outside what base spans cover."""
    return [(s, 3, e) for s, e, v in contexts(text, base) if guess_cost(v, ranks) >= least]


def words_of(text: str) -> set[str]:
    """Lower-case words of the text, apart from values in credential context and fixed patterns, which aren't to vouch for themselves."""
    hidden = base_spans(text)
    if any(w in text.lower() for w in _CONTEXT_WORDS):
        hidden += [(m.start(2), 3, m.end(2)) for m in _CONTEXT.finditer(text)]
    tokens = {t.strip(_EDGES) for t in set(redact(text, sorted(hidden), " ").split())}
    return {t.lower() for t in tokens if _SHORTEST <= len(t) <= _LONGEST and t.isalpha()}


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all documents, whatever their language: in how many texts a word stands, if in two at least that differ. Written.

    Words are counted a task first, so no word makes a large one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        ends: dict[str, tuple[int, int]] = {}

        def rows() -> pa.RecordBatch:
            low, high = zip(*(ends[w] for w in n)) if n else ((), ())
            cols = [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64())]
            return pa.RecordBatch.from_arrays(cols, ["word", "n", "low", "high"])

        for b in batches:
            for t, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for w in words_of(t):
                    n[w] += 1
                    a, z = ends.get(w, (h, h))
                    ends[w] = (min(a, h), max(z, h))
            if len(n) > 100_000:
                yield rows()
                n.clear()
                ends.clear()
        yield rows()

    part = docs.where("text is not null").select("text", F.xxhash64("text").alias("h")).mapInArrow(run, "word string, n long, low long, high long")
    every = part.groupBy("word").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("word", "n")
    return common.materialize(every, "word-counts")


def _named(v: str) -> Column:
    """128 bits that stand for a value, so that a long one doesn't travel with each of its words."""
    return F.struct(F.xxhash64(v).alias("i"), F.xxhash64(F.lit(11), F.col(v)).alias("j"))


def costly_values(values: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """(id) of values(v), each once, whose guess cost is at least 10**least, with the ranks of all words of the corpus. Written.

    A word's rank is one more than the number of words that stand in more texts; COMMON_WORDS keep theirs where it is smaller. Only ranks of words
    that a value holds travel to it: its letter runs of _SHORTEST to _LONGEST are joined to words(word, n). Ranks come from the counts
    by number of texts, one row for each number that occurs.
    """
    values = common.materialize(values.distinct().withColumn("id", _named("v")), "secret-values")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("i", pa.int64()), ("j", pa.int64())])
        for b in batches:
            for v, who in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                low = v.lower() if len(v.lower()) == len(v) else v
                for x in {low, low.translate(_SWAPS)}:
                    runs = {x[j:i] for i in range(_SHORTEST, len(x) + 1) for j in range(max(0, i - _LONGEST), i - _SHORTEST + 1) if x[j:i].isalpha()}
                    yield pa.RecordBatch.from_arrays([pa.array([who] * len(runs), kind), pa.array(list(runs), pa.string())], ["id", "word"])

    held = values.select("v", "id").mapInArrow(parts, "id struct<i:bigint,j:bigint>, word string").distinct()
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = words.groupBy("n").agg(F.count(F.lit(1)).alias("k")).select("n", (F.coalesce(F.sum("k").over(above), F.lit(0)) + 1).alias("rank"))
    ranked = held.join(words, "word").join(ranks, "n").groupBy("id").agg(F.collect_list("word").alias("ws"), F.collect_list("rank").alias("rs"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for v, ws, rs in zip(*(b.column(c).to_pylist() for c in ("v", "ws", "rs")), strict=True):
                own = dict(zip(ws or (), rs or (), strict=True))
                keep.append(guess_cost(v, own | {w: min(k, own.get(w, k)) for w, k in _RANK.items()}) >= least)
            yield pa.RecordBatch.from_arrays([b.column("id").filter(pa.array(keep, pa.bool_()))], ["id"])

    out = values.join(ranked, "id", "left").select("v", "ws", "rs", "id").mapInArrow(judge, "id struct<i:bigint,j:bigint>")
    out = common.materialize(out, "secret-ids")
    common.discard(values)
    return out


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "<secret>") -> str:
    """text with each run of overlapping spans replaced by mark."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_SPANS = "array<struct<s:int,k:int,e:int>>"
_CONTEXTS = "array<struct<s:int,e:int,v:string>>"
_SPAN_TYPE = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))
_CONTEXT_TYPE = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("v", pa.string())]))


def _found(base: list[tuple[int, int, int]], values: list[tuple[int, int, str]]) -> tuple[list[dict], list[dict]]:
    return [{"s": s, "k": k, "e": e} for s, k, e in base], [{"s": s, "e": e, "v": v} for s, e, v in values]


def _guessed(found: DataFrame, key: list[str], docs: DataFrame, least: float) -> DataFrame:
    """(key, guesses): the spans of found(key, contexts) whose values are costly, for keys that have some. Written."""
    words = word_counts(docs)
    each = found.select(*key, F.explode("contexts").alias("c")).select(*key, "c.*")
    bad = costly_values(each.select("v"), words, least)
    hit = each.withColumn("id", _named("v")).join(bad, "id", "left_semi")
    span = F.struct("s", F.lit(3).alias("k"), "e")
    out = common.materialize(hit.groupBy(*key).agg(F.array_sort(F.collect_set(span)).cast(_SPANS).alias("guesses")), "secret-guesses")
    common.discard(words, bad)
    return out


def scan(docs: DataFrame, least: float = 9.0) -> DataFrame:
    """Secrets of every whole text: doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans.

    A null text counts as empty; a row without secrets has zeros, an empty span list and the digest of "". Repeated rows
    give repeated results, an empty table an empty one, columns besides doc_id and text are left out. Texts are read twice and never
    shuffled: what is found in each row is written and numbered, and values, judged once each, are joined back to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, values, digests = [], [], []
            for t in b.column(1).to_pylist():
                base = base_spans(t or "")
                one = _found(base, contexts(t or "", base))
                spans.append(one[0])
                values.append(one[1])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.string()), pa.array(spans, _SPAN_TYPE), pa.array(values, _CONTEXT_TYPE)], ["doc_id", "base_sha256", "base", "contexts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, base_sha256 string, base {_SPANS}, contexts {_CONTEXTS}")
    found = common.materialize(found.withColumn("row", F.monotonically_increasing_id()), "secret-contexts")
    guessed = _guessed(found.where(F.size("contexts") > 0), ["row"], docs, least)
    guesses = F.coalesce("guesses", F.array().cast(_SPANS))
    names = F.array(*map(F.lit, KINDS))
    shown = F.transform(F.array_sort(F.concat("base", guesses)), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"]))
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.join(guessed, "row", "left").select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.size(guesses).cast("long").alias("n_guess"), "base_sha256",
        F.array_join(shown, ",").alias("spans"),
    )


def redacted(docs: DataFrame, least: float = 9.0) -> DataFrame:
    """docs with every secret span of the text replaced by <secret>.

    Null and empty texts stay as they are, so do other columns whatever their names; equal rows change alike; an empty table stays empty.
    Guessed spans are found for each text once and joined to its rows by 128 bits of hash.
    """
    t1, t2, more = common.unused(docs.columns, "t1", "t2", "guesses")
    at = docs.columns.index("text")
    marked = docs.withColumns({t1: F.xxhash64("text"), t2: F.xxhash64(F.lit(11), F.col("text"))})

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [_found([], contexts(t, base_spans(t)))[1] for t in b.column(0).to_pylist()]
            keep = pa.array([bool(v) for v in values], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(1).filter(keep), b.column(2).filter(keep), pa.array(values, _CONTEXT_TYPE).filter(keep)], ["t1", "t2", "contexts"])

    found = marked.where(F.col("text").isNotNull()).select("text", t1, t2).mapInArrow(look, f"t1 long, t2 long, contexts {_CONTEXTS}")
    found = common.materialize(found.groupBy("t1", "t2").agg(F.first("contexts").alias("contexts")), "secret-contexts")
    guessed = _guessed(found, ["t1", "t2"], docs, least)
    common.discard(found)
    g = guessed.select(F.col("t1").alias(f"{more}_1"), F.col("t2").alias(f"{more}_2"), F.col("guesses").alias(more))
    joined = marked.join(g, (F.col(t1) == F.col(f"{more}_1")) & (F.col(t2) == F.col(f"{more}_2")), "left").select(*[F.col(f"`{c}`") for c in docs.columns], more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t, extra in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                if t is not None:
                    t = redact(t, sorted(base_spans(t) + [(x["s"], x["k"], x["e"]) for x in extra or ()]))
                texts.append(t)
            cols = list(b.columns)[:-1]
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, b.schema.names[:-1])

    return joined.mapInArrow(run, docs.schema)
