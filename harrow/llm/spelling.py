"""Spelling variants: words one edit apart, grouped under the far more frequent spelling.

Words are counted over all texts. The near-word join is a q-gram prefix filter: positional bigrams are ordered by how many words
hold them, each word is found by its three rarest alone, and two words meet only where such a bigram stands at places that one edit
allows. One edit destroys two bigrams at most, so of three one survives, and the word whose third bigram is the more frequent has it
among its own three. Candidates are then verified by edit distance.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize

#: Fixed value of the contract: maximal runs of these letters, here after A-Z became a-z.
LETTERS = r"[a-zÀ-ÿ]"
#: Pairs whose shorter word has more code points meet by halves, not by bigrams.
LONG = 64


def runs_of(text: Column, least: int = 1) -> Column:
    """Maximal runs of letters of at least `least` code points, A-Z in lower case (a run is maximal as the pattern is greedy)."""
    return F.regexp_extract_all(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), F.lit(f"({LETTERS}{{{least},}})"), F.lit(1))


def misspelt(doc_id: Column, run: Column, every: int) -> Column:
    """The run, or the run less one code point where the CRC-32 of `<doc_id>:<run>` is a multiple of `every`."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, least_chars: int = 6, least_n: int = 5, every: int = 199) -> DataFrame:
    """(word, n): words of at least least_chars code points with at least least_n occurrences in all texts.

    A run too short to give such a word is left out at once. Occurrences are summed before the shuffle. Null texts have no words; a
    null doc_id is written as nothing before the colon; repeated rows count as often as they stand there.
    """
    every_run = docs.select(F.col(doc_id).alias("id"), F.explode(runs_of(F.col(text), least_chars)).alias("run"))
    words = every_run.select(misspelt(F.col("id"), F.col("run"), every).alias("word")).where(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


def rarest_bigrams(words: DataFrame) -> DataFrame:
    """words(word, n) with codes: the three rarest positional bigrams of each word, and the further places of the third where it is repeated.

    A code is a bigram's place in the order of the number of places that hold it (ties by the bigram), times 2**32, plus its place in the
    word. Repetitions of the third have to count, or a surviving bigram could hide behind an earlier copy of itself. The letters allow
    8,100 bigrams at most, so their order is small whatever the corpus is. Words of more than LONG + 1 code points have no codes.
    """
    short = words.where(F.length("word") <= LONG + 1)
    grams = short.select("word", "n", F.posexplode(F.regexp_extract_all("word", F.lit(r"(?s)(?=(..))"), F.lit(1))).alias("p", "g"))
    order = grams.groupBy("g").agg(F.count("*").alias("f")).select("g", F.row_number().over(Window.orderBy("f", "g")).cast("long").alias("r"))
    coded = grams.join(F.broadcast(order), "g").groupBy("word", "n").agg(F.array_sort(F.collect_list(F.shiftleft("r", 32) + F.col("p"))).alias("all"))
    third = F.coalesce(F.get("all", F.lit(2)), F.element_at("all", -1))
    coded = coded.withColumn("end", F.shiftleft(F.shiftright(third, 32) + 1, 32)).select("word", "n", F.filter("all", lambda c: c < F.col("end")).alias("codes"))
    return coded.union(words.where(F.length("word") > LONG + 1).select("word", "n", F.array().cast("array<long>").alias("codes")))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): how many words(word, n) are one inserted, deleted or replaced code point away, and the best of them.

    best is struct(o, form) with o the negative count: the most frequent one, ties to the first in code-point order. words are
    distinct and have four code points or more. Two words meet by a bigram among the three rarest of both: at the same place if they are equally long,
    else at the same or the next place of the longer one. Crowded bigrams are split by what one edit leaves: the first half of the
    shorter word is the start of the other or its second half the end, and that half goes into the key, so words that merely
    share a bigram never meet. Words of more than LONG code points meet by their halves alone, so that no word travels with each of its
    letters. A pair that meets by several keys counts at the first of them, which both words' codes tell: pairs are never shuffled.
    """
    n = F.length("word")
    half, below = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")  # below: half of a word one shorter
    head = lambda k: F.xxhash64(F.substring(F.col("word"), F.lit(1), k))
    tail = lambda k: F.xxhash64(F.substring(F.col("word"), n - k + 1, k))
    parts = {"size": n, "head": head(half), "tail": tail(n - half), "short_head": head(below), "short_tail": tail(n - 1 - below)}
    own = materialize(rarest_bigrams(words).select("*", *[c.alias(k) for k, c in parts.items()]), "spelling-codes")
    codes = lambda size: F.when(size > LONG, F.array(F.lit(-1).cast("long"))).otherwise(F.col("codes"))

    def met_by(role: list[tuple[int, int]], size: Column, first: str, second: str, prefix: str) -> DataFrame:
        """A row a key: role has (is the pair of different length, how much later the bigram stands in the longer word)."""
        key = lambda c, longer, left, later: F.struct(
            F.xxhash64(F.lit(longer), F.lit(left), size, F.col(first if left else second), c + later).alias("key"), F.lit(longer).alias("longer"),
            F.lit(left).alias("left"), F.lit(later).alias("later"), c.alias("code"),
        )
        every = F.flatten(F.transform(codes(size), lambda c: F.array(*[key(c, longer, left, later) for longer, later in role for left in (1, 0)])))
        out = own.select("word", F.col("n"), codes(size).alias("codes"), F.explode(every).alias("k")).select("k.*", "word", "n", "codes")
        return out.select("key", *[F.col(c).alias(prefix + c) for c in ("longer", "left", "later", "code", "word", "n", "codes")])

    size = F.col("size")
    a = met_by([(0, 0), (1, 0), (1, 1)], size, "head", "tail", "a_")
    b = met_by([(0, 0)], size, "head", "tail", "b_").union(met_by([(1, 0)], size - 1, "short_head", "short_tail", "b_"))
    met = a.join(b, "key").where("a_longer = b_longer and a_left = b_left and b_code = a_code + a_later and (a_longer = 1 or a_word < b_word)")
    start = F.floor(F.length("a_word") / 2).cast("int")
    same_start = F.substring(F.col("a_word"), F.lit(1), start) == F.substring(F.col("b_word"), F.lit(1), start)
    met = met.where((F.col("a_left") == 1) | ~same_start).where(F.levenshtein("a_word", "b_word", 1) == 1)
    here = F.array_min(F.array_intersect("a_codes", "b_codes"))
    later = F.array_min(F.array_intersect(F.transform("a_codes", lambda c: c + 1), "b_codes")) - 1
    at_once = here.isNotNull() & (later.isNull() | (F.col("a_longer") == 0) | (here <= later))
    met = met.where(F.when(at_once, (F.col("a_later") == 0) & (F.col("a_code") == here)).otherwise((F.col("a_later") == 1) & (F.col("a_code") == later)))
    ways = F.array(*[F.struct(F.col(x + "word").alias("word"), (-F.col(y + "n")).alias("o"), F.col(y + "word").alias("form")) for x, y in (("a_", "b_"), ("b_", "a_"))])
    out = met.select(F.explode(ways).alias("w")).groupBy("w.word").agg(F.count("*").alias("n_near"), F.min(F.struct("w.o", "w.form")).alias("best"))
    out = materialize(out, "spelling-near")
    discard(own)
    return out


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, least_chars: int = 6, least_n: int = 5, every: int = 199, times: int = 5) -> DataFrame:
    """Every word with its form, the root its forms lead to, its count, the number of its near words and the form's count.

    The form is the near word of largest count (ties: the first in code-point order) if that count is at least `times` the word's.
    Counts grow along forms, so they end after a few steps; roots are found by pointer doubling, each step written. least_chars is four
    at least (three bigrams, or the filter has nothing to go by). Nulls and repeated rows as in vocabulary(); an empty table gives an empty one.
    """
    if least_chars < 4 or times < 2:
        raise ValueError("least_chars has to be 4 at least and times 2 at least")
    words = materialize(vocabulary(docs, doc_id, text, least_chars=least_chars, least_n=least_n, every=every), "spelling-words")
    near = near_words(words)
    led = words.join(near, "word", "left")
    led = led.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.o")).alias("form_n"))
    good = F.col("form_n") >= times * F.col("n")
    led = materialize(led.select("word", "n", "n_near", F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n")), "spelling-forms")
    to = materialize(led.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        nxt = materialize(to.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        discard(to)
        to = nxt
        if to.where("moved").isEmpty():
            break
        to = nxt.select("word", "root")
        to._harrow_path = nxt._harrow_path
    discard(words, near)
    return led.join(to.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
