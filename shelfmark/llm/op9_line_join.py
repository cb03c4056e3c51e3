"""Line dedup by an exact set-similarity join of lines, in DataFrame operations alone.

A line is the set of its words. Its tokens are ordered by rarity, and only a prefix of the
rarest is indexed: two lines of Jaccard similarity 0.8 must share a token of their prefixes.
Length, the position of the shared token and a bitmap of each line bound the overlap from above
before anything is verified. A long line shares some rare token with very many others. There two
tokens that follow each other in the order of rarity make a key, and the bitmap is wider: of
n tokens at most 2(n-o) + (m-o) such pairs are lost to a line of m tokens that has o of them, which
is at most 0.4n, so two similar long lines share a pair in a prefix of 0.4n + 2. A pair of lines so
found is compared by the prefixes that both have, and only what may still be similar by its words:
the Jaccard similarity is then taken over all words of both lines.

Lines with equal words in equal order are one class, known by its first place in the corpus. A
class falls to any earlier class that is similar to it, so one similar earlier class is enough. A
first round asks the earliest class with the smallest, and with the largest, hash in its prefix:
that settles most of a group of many near copies at a linear cost. Members of such a group that
are not similar to its earliest ones go through a second round, in which they ask one holder each of
several hashes and deals. The join by prefixes then asks every earlier holder of a token for the rest,
and is exact whatever the rounds found.
It goes over the keys in parts, so that the postings of one part are on disk at a time.

A line of few distinct words has no set to speak of. It is the sequence of its words: if it is
long, it goes where it equals an earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.common import let
from shelfmark.llm.words import documents, free_shuffles, store

PERCENT = 80
#: Lines of fewer distinct words are not compared as sets.
MIN_WORDS = 5
#: Of those, lines of so many words in all (or characters of a script without spaces), or of so
#: many characters, go where they equal an earlier one. Others are short: one that recurs may
#: be no copy.
EXACT_WORDS, EXACT_CHARS = 10, 60
#: Bits of a word's hash by which frequencies are counted, and those that tell apart words of
#: one frequency. Words that share a token cost a comparison, never a result.
RARITY_BITS, WORD_BITS = 17, 14
#: Lines of more distinct words are found by pairs of tokens; so are those that may be similar to
#: one of them, besides.
LONG_WORDS = 64
#: 64-bit words of the bitmap of a line that is found by pairs.
WIDE = 4
#: Classes with a key of the first round that so many hold go through the second one, or twice, four
#: times as many and so on, until the classes are at most one of so many of all.
CROWD, CROWD_PART = 16, 8
#: Hashes of a prefix in the second round, and deals of a hash's holders, of which the earliest each is asked.
SEEDS, DEALS = 8, 4
#: Parts into which the join divides the keys, by their last bits. All are joined, one after the other.
KEY_PARTS = 2
#: Documents, and line numbers in all, of a table that may be broadcast; a larger one is
#: joined by a shuffle instead. So are more places than BROADCAST_DOCS.
BROADCAST_DOCS, BROADCAST_LINES = 1_000_000, 4_000_000

#: Fixed: the white space that separates words within a line.
SPACES = "[ \t\x0b\f\r]+"
#: Fixed: all but the characters of scripts that put no space between words.
SPACED = r"[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]+"
#: What a line is: compared as a set, by equality alone, or short.
SET, EXACT, SHORT = 0, 1, 2
#: Stands for a null doc_id, which comes before all others.
NULL_ID = -(1 << 63)


def _split(line: Column) -> Column:
    """Words of a line, with empty ones where blanks meet."""
    odd = F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\x0b")) | F.contains(line, F.lit("\f")) | F.contains(line, F.lit("\r"))
    # Most lines have blanks alone, by which they are split without a regular expression.
    return F.when(odd, F.split(line, SPACES)).otherwise(F.split(line, " "))


def all_words(line: Column) -> Column:
    """Lower-cased words, as 64-bit hashes."""
    return F.transform(F.array_remove(_split(line), ""), lambda w: F.xxhash64(w))


def line_words(line: Column) -> Column:
    """Distinct lower-cased words, as 64-bit hashes."""
    return F.array_distinct(all_words(line))


def _bucket(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - RARITY_BITS)


def rarity_ranks(docs: DataFrame) -> Column:
    """A constant array: for each hash bucket the rank of its frequency over all documents, above
    WORD_BITS other bits.

    Buckets are counted, not words, so the array has a fixed size; the rarest words are told
    apart by their hash. Any common order of tokens gives the same result.
    """
    word = F.explode(_split(F.replace(F.lower("text"), F.lit("\n"), F.lit(" "))))
    counts = docs.select(word.alias("w")).groupBy(_bucket(F.xxhash64("w")).alias("b")).count().collect()
    known = {r.b: r["count"] for r in counts}
    ranks = [0] * (1 << RARITY_BITS)
    for rank, b in enumerate(sorted(range(1 << RARITY_BITS), key=lambda b: (known.get(b, 0), b))):
        ranks[b] = rank << WORD_BITS
    return F.from_json(F.lit("[" + ",".join(map(str, ranks)) + "]"), "array<bigint>")


def _tokens(words: Column, ranks: Column) -> Column:
    """Hashes as sorted tokens: rank of the bucket above, some other bits of the hash below."""
    # An array that is known to hold no null is sorted as plain numbers.
    rank = lambda h: F.coalesce(F.get(ranks, _bucket(h).cast("int")), F.lit(0).cast("long"))
    return F.sort_array(F.transform(words, lambda h: rank(h).bitwiseOR(h.bitwiseAND(F.lit((1 << WORD_BITS) - 1)))))


def _prefix(n: Column) -> Column:
    """Tokens of a line of n that it must share one of with any similar line."""
    return n - F.floor((PERCENT * n + 99) / 100).cast("int") + 1


def _is_paired(n: Column) -> Column:
    return 100 * n > PERCENT * LONG_WORDS


def _kept(n: Column) -> Column:
    """Tokens of a line of n that are needed for its keys."""
    return F.when(_is_paired(n), F.ceil(2 * (100 - PERCENT) * n / 100).cast("int") + 2).otherwise(_prefix(n))


def _keys(n: Column, prefix: Column) -> Column:
    """(i, key): place of each token of the prefix; for pairs of tokens -1 - the number of tokens
    before the second one (-1 where both are equal, so that the place says nothing)."""
    single = F.transform(F.slice(prefix, F.lit(1), _prefix(n)), lambda x, i: F.struct(i.alias("i"), x.cast("long").alias("key")))
    pairs = F.transform(F.slice(prefix, F.lit(1), F.size(prefix) - 1), lambda x, i: F.struct(F.when(x == F.get(prefix, i + 1), -1).otherwise(-2 - i).alias("i"), F.xxhash64(x, F.get(prefix, i + 1)).alias("key")))
    return F.when(~_is_paired(n), single).when(n > LONG_WORDS, pairs).otherwise(F.concat(single, pairs))


def _bitmap(tokens: Column) -> Column:
    """64 bits, of which each token sets that of its last six bits."""
    one = F.lit(1).cast("long")
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(F.call_function("shiftleft", one, x.bitwiseAND(F.lit(63)).cast("int"))))


def _share(tokens: Column, part: int) -> Column:
    """Tokens that belong to one word of a wide bitmap."""
    return F.filter(tokens, lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(WIDE - 1)) == part)


def line_table(docs: DataFrame) -> DataFrame:
    """One row per line of ``docs`` (d, text): place (d, l), kind (null without words), two hashes of
    its words in order; size, prefix and bitmaps of a set."""
    ranks = rarity_ranks(docs)
    # posexplode_outer and a filter: with posexplode the optimizer copies the split below it.
    opened = docs.select("d", F.posexplode_outer(F.split(F.lower("text"), "\n")).alias("l", "line"))
    lines = opened.where("line IS NOT NULL").select("d", "l", "line", line_words(F.col("line")).alias("w"))
    line, n = F.col("line"), F.size("w")
    is_set = n >= MIN_WORDS
    every = all_words(line)
    exact = (F.size(every) + F.length(F.regexp_replace(line, SPACED, "")) >= EXACT_WORDS) | (F.length(F.regexp_replace(line, SPACES, "")) >= EXACT_CHARS)
    kind = F.when(is_set, SET).when(n == 0, None).when(exact, EXACT).otherwise(SHORT)
    h1 = F.when(is_set, F.xxhash64(line)).otherwise(F.xxhash64(F.lit(2), every))
    h2 = F.when(is_set, F.xxhash64(F.lit(1), line)).otherwise(F.xxhash64(F.lit(3), every))
    sets = lines.select("d", "l", kind.alias("kind"), h1.alias("h1"), h2.alias("h2"), n.alias("n"), F.when(is_set, _tokens(F.col("w"), ranks)).alias("t"))
    n, t = F.col("n"), F.col("t")
    wide = F.struct(*[_bitmap(_share(t, part)).alias(f"b{part}") for part in range(WIDE)])
    return sets.select("d", "l", "kind", "h1", "h2", "n", F.slice("t", F.lit(1), _kept(n)).cast("array<int>").alias("prefix"), F.when(n <= LONG_WORDS, _bitmap(t)).alias("bits"), F.when(_is_paired(n), wide).alias("wide"))


def line_classes(lines: DataFrame) -> DataFrame:
    """One row per distinct line: kind, first place (d, l), number of lines, and what belongs to
    the set. Equal lines are merged before the shuffle, so one of a third of all rows is none."""
    same = [F.first(c).alias(c) for c in ("kind", "n", "prefix", "bits", "wide")]
    firsts = lines.groupBy("h1", "h2").agg(F.min(F.struct("d", "l")).alias("at"), F.count("*").alias("copies"), *same)
    return firsts.select("h1", "h2", "kind", "at.d", "at.l", "copies", "n", "prefix", "bits", "wide")


def _bound(n: Column, m: Column, apart: Column) -> Column:
    """Whether sets of n and m tokens, whose bitmaps differ in ``apart`` bits, may have the
    overlap needed, which times (100 + PERCENT) is PERCENT * (n + m)."""
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & ((100 + PERCENT) * (n + m - apart) >= 2 * PERCENT * (n + m))


def _by_place(n: Column, m: Column, i: Column, j: Column) -> Column:
    """The most words that sets of n and m tokens may share, given the places of a key (see
    ``_keys``) that both have: if it is a token, the first they share."""
    before, also = -1 - i, -1 - j
    return F.when(i >= 0, F.least(n - i, m - j)).otherwise(F.least(before, also) + F.least(n - before, m - also))


def _missing(pairs: DataFrame) -> DataFrame:
    """``pairs`` (xn, xp, yn, yp) whose prefixes leave room for the overlap needed.

    A word of the prefix that ends at the rarer token is in the other line's prefix or not in
    that line at all, so each one missing there is lost to the overlap. Tokens that two words
    of a line share are counted once, which only makes the loss smaller.
    """
    lost = F.when(
        F.element_at("xp", -1) <= F.element_at("yp", -1), F.col("xn") - F.size(F.array_except("xp", "yp"))
    ).otherwise(F.col("yn") - F.size(F.array_except("yp", "xp")))
    return pairs.where((100 + PERCENT) * lost >= PERCENT * (F.col("xn") + F.col("yn")))


def _apart(x, y) -> Column:
    """Bits in which two bitmaps differ; ``x`` and ``y`` give the columns of either line."""
    narrow = F.bit_count(x("bits").bitwiseXOR(y("bits")))
    wide = sum((F.bit_count(x("wide")[f"b{part}"].bitwiseXOR(y("wide")[f"b{part}"])) for part in range(1, WIDE)), F.bit_count(x("wide")["b0"].bitwiseXOR(y("wide")["b0"])))
    return F.coalesce(wide, narrow, F.lit(0))


def _small(lists: DataFrame) -> bool:
    """Whether a stored table (d, ls) may be broadcast."""
    size = lists.limit(BROADCAST_DOCS + 1).agg(F.count("*").alias("docs"), F.sum(F.size("ls")).alias("lines")).first()
    return size.docs <= BROADCAST_DOCS and (size.lines or 0) <= BROADCAST_LINES


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Later places (d, l) of the pairs (xd, xl, yd, yl) of ``classes`` whose lines are similar.
    Prefixes come first; only the lines that are still asked for leave their documents."""
    pairs = pairs.distinct()
    for side in "xy":
        heads = classes.select(*[F.col(c).alias(side + c) for c in ("d", "l", "n")], F.col("prefix").alias(f"{side}p"))
        pairs = pairs.join(heads, [f"{side}d", f"{side}l"])
    pairs = store(_missing(pairs).select("xd", "xl", "yd", "yl"), "line-pairs")
    places = pairs.select(F.explode(F.array(F.struct(F.col("xd").alias("d"), F.col("xl").alias("l")), F.struct(F.col("yd").alias("d"), F.col("yl").alias("l")))).alias("p"))
    wanted = store(places.groupBy(F.col("p.d").alias("d")).agg(F.collect_set("p.l").alias("ls")), "line-places")
    texts = docs.join(F.broadcast(wanted) if _small(wanted) else wanted, "d")
    cut = let(F.split(F.lower("text"), "\n"), lambda parts: F.transform("ls", lambda l: F.struct(l.alias("l"), line_words(F.get(parts, l)).alias("w"))))  # noqa: E741
    words = store(texts.select("d", F.explode_outer(cut).alias("c")).select("d", "c.l", "c.w").dropDuplicates(["d", "l"]), "line-words")
    both = pairs.join(words.select(F.col("d").alias("xd"), F.col("l").alias("xl"), F.col("w").alias("x")), ["xd", "xl"])
    both = both.join(words.select(F.col("d").alias("yd"), F.col("l").alias("yl"), F.col("w").alias("y")), ["yd", "yl"])
    common = F.size(F.array_intersect("x", "y"))
    similar = both.where((100 + PERCENT) * common >= PERCENT * (F.size("x") + F.size("y")))
    return similar.select(F.col("yd").alias("d"), F.col("yl").alias("l")).distinct()


def _ends(classes: DataFrame) -> DataFrame:
    """The smallest and the largest hash ``k`` in the prefix of each class."""
    mixed = F.transform(F.slice("prefix", F.lit(1), _prefix(F.col("n"))), lambda x: F.hash(x))
    ends = F.array(F.struct(F.lit(0).alias("side"), F.array_min(mixed).alias("key")), F.struct(F.lit(1).alias("side"), F.array_max(mixed).alias("key")))
    return classes.select("d", "l", "n", "bits", "wide", F.explode_outer(ends).alias("k"))


def _earliest(keys: DataFrame, *by) -> DataFrame:
    """For each value of ``by`` its first holder (od, ol) with size and bitmaps, and the number of
    holders. Of lines of one document any may stand for it: numbers alone need no sort."""
    bits = {f"o{c}": F.col(c) for c in ("l", "n", "bits")} | {f"o{c}": F.col(f"wide.{c}") for c in (f"b{part}" for part in range(WIDE))}
    return keys.groupBy(*by).agg(F.min("d").alias("od"), *[F.min_by(c, F.col("d")).alias(name) for name, c in bits.items()], F.count("*").alias("holders"))


def _may_be_similar() -> Column:
    """Whether (od, ol) is an earlier place than (d, l) and its line may be similar."""
    earlier = (F.col("od") < F.col("d")) | ((F.col("od") == F.col("d")) & (F.col("ol") < F.col("l")))
    wide = F.struct(*[F.col(f"ob{part}").alias(f"b{part}") for part in range(WIDE)])
    return earlier & _bound(F.col("on"), F.col("n"), _apart(lambda c: wide if c == "wide" else F.col("o" + c), F.col))


def _pairs(asked: DataFrame) -> DataFrame:
    return asked.select(F.col("od").alias("xd"), F.col("ol").alias("xl"), F.col("d").alias("yd"), F.col("l").alias("yl"))


def _first_asked(classes: DataFrame) -> DataFrame:
    """Each class (d, l) with the earliest one (od, ol) that has one of its keys, if that may be similar, and the
    number of holders of the key, where there is such a class or a crowd."""
    mixed = F.transform(F.slice("prefix", F.lit(1), _prefix(F.col("n"))), lambda x: F.hash(x))
    ends = F.array(F.struct(F.lit(0).alias("side"), F.array_min(mixed).alias("key")), F.struct(F.lit(1).alias("side"), F.array_max(mixed).alias("key")))
    keys = classes.select("d", "l", "n", "bits", "wide", F.explode_outer(ends).alias("k"))
    asked = keys.join(_earliest(keys, "k").where("holders > 1"), "k").withColumn("asks", _may_be_similar())
    return asked.where(F.col("asks") | (F.col("holders") >= CROWD)).select("d", "l", "od", "ol", "asks", "holders")


def _second_asked(crowd: DataFrame) -> DataFrame:
    """The open classes (d, l) of ``crowd`` with those (od, ol) that they ask by other hashes of
    their prefixes: the earliest in each deal of the holders."""
    tokens = F.slice("prefix", F.lit(1), _prefix(F.col("n")))
    least = lambda seed: F.array_min(F.transform(tokens, lambda x: F.xxhash64(F.lit(seed), x)))
    mixed = F.array(*[F.struct(F.lit(seed).alias("seed"), least(seed).alias("key")) for seed in range(SEEDS)])
    keys = crowd.select("d", "l", "n", "bits", "wide", "open", F.explode_outer(mixed).alias("k"))
    deal = F.pmod(F.xxhash64("d", "l", "k"), F.lit(DEALS)).alias("deal")
    return keys.where("open = 1").join(_earliest(keys, "k", deal), "k").where(_may_be_similar())


def _asked(flagged: DataFrame, part: int) -> DataFrame:
    """Pairs (xd, xl, yd, yl) of a class and a later open one that share a key of this part, and
    may be similar."""
    postings = flagged.select("d", "l", "n", "bits", "wide", "open", F.inline_outer(_keys(F.col("n"), F.col("prefix"))))
    postings = postings.where(F.col("key").bitwiseAND(F.lit(KEY_PARTS - 1)) == part)
    x, y = (postings.select("key", *[F.col(c).alias(side + c) for c in ("d", "l", "n", "bits", "wide", "open", "i")]) for side in "xy")
    xn, yn = F.col("xn"), F.col("yn")
    earlier = (F.col("xd") < F.col("yd")) | ((F.col("xd") == F.col("yd")) & (F.col("xl") < F.col("yl")))
    # Only open classes ask. Written with both sides' flags, so that the filter stays in the
    # join and both sides read one and the same shuffle.
    asks = F.col("xopen") + 2 * F.col("yopen") >= 2
    near = ((100 + PERCENT) * _by_place(xn, yn, F.col("xi"), F.col("yi")) >= PERCENT * (xn + yn)) & _bound(xn, yn, _apart(lambda c: F.col("x" + c), lambda c: F.col("y" + c)))
    return x.join(y, "key").where(asks & earlier & near).select("xd", "xl", "yd", "yl").distinct()


def _crowded(asked: DataFrame, most: int) -> DataFrame:
    """Places (d, l) of the classes in the largest crowds, at most ``most``. The others' pairs are
    left to the exact join, so that the second round stays small beside it."""
    held = store(asked.where(F.col("holders") >= CROWD).groupBy("d", "l").agg(F.max("holders").alias("holders")), "crowded-lines")
    counts = dict(held.groupBy(F.floor(F.log2(F.col("holders") / CROWD)).cast("int")).count().collect())
    power, total = max(counts, default=-1) + 1, 0
    while power > 0 and total + counts.get(power - 1, 0) <= most:
        power -= 1
        total += counts.get(power, 0)
    return held.where(F.col("holders") >= CROWD << power).select("d", "l")


def _few(places: DataFrame) -> bool:
    """Whether a stored table of places may be broadcast."""
    return places.limit(BROADCAST_DOCS + 1).count() <= BROADCAST_DOCS


def _among(classes: DataFrame, places: DataFrame) -> DataFrame:
    """The classes at the stored ``places`` (d, l)."""
    return classes.join(F.broadcast(places) if _few(places) else places, ["d", "l"], "left_semi")


def _flagged(classes: DataFrame, settled: DataFrame) -> DataFrame:
    """``classes`` with ``open``: 0 at the stored places of ``settled``, else 1."""
    mark = settled.withColumn("settled", F.lit(1))
    flagged = classes.select("d", "l", "n", "bits", "wide", "prefix").join(F.broadcast(mark) if _few(settled) else mark, ["d", "l"], "left")
    return flagged.withColumn("open", F.when(F.col("settled").isNull(), 1).otherwise(0))


def similar_classes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Places (d, l) of the classes that have a similar earlier one."""
    spark = docs.sparkSession
    asked = store(_first_asked(classes), "asked-ends")
    settled = store(_verified(_pairs(asked.where("asks")), classes, docs), "settled-lines")
    free_shuffles(spark)
    crowded = _crowded(asked, classes.count() // CROWD_PART)
    crowd = store(_flagged(_among(classes, crowded), settled), "crowd")
    settled = settled.unionByName(store(_verified(_pairs(_second_asked(crowd)), crowd, docs), "settled-in-crowds"))
    free_shuffles(spark)
    flagged = _flagged(classes, settled)
    pairs = None
    for part in range(KEY_PARTS):
        asked = store(_asked(flagged, part), "asked-lines")
        free_shuffles(spark)
        pairs = asked if pairs is None else pairs.unionByName(asked)
    return settled.unionByName(_verified(pairs, classes, docs))


def _with_short(lines: DataFrame, classes: DataFrame, gone: DataFrame) -> DataFrame:
    """``gone`` (d, ls) and the short lines that went along with copies: those between removed
    lines, or between one and an end of the document, that equal an earlier line."""
    held = lines.join(F.broadcast(gone.select("d")) if _small(gone) else gone.select("d"), "d", "left_semi")
    held = held.groupBy("d").agg(F.sort_array(F.collect_set(F.struct("l", "kind"))).alias("held")).join(gone, "d")
    # r: removed, k: kept, c: short, which becomes s in a run that begins or ends at a k.
    marks = F.array_join(F.transform("held", lambda x: F.when(F.array_contains("ls", x["l"]), "r").when(x["kind"] == SHORT, "c").otherwise("k")), "")
    for _ in range(2):
        marks = F.reverse(F.regexp_replace(marks, r"\G(?!^)c|(?<=k)c", "s"))
    marked = held.select("d", F.explode_outer(F.arrays_zip(F.col("held.l").alias("l"), F.split(marks, "").alias("mark"))).alias("x"))
    between = marked.where("x.mark = 'c'").select("d", "x.l")
    copies = between.join(classes.where(F.col("kind") == SHORT).select("d", "l"), ["d", "l"], "left_anti")
    return gone.select("d", F.explode("ls").alias("l")).unionByName(copies).groupBy("d").agg(F.collect_set("l").alias("ls"))


def repeated_lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """Numbers ``ls`` of the lines to remove from each document ``d`` of ``docs`` (d, text)."""
    lines = store(line_table(docs), "lines").where("kind IS NOT NULL")
    classes = store(line_classes(lines), "line-classes")
    free_shuffles(docs.sparkSession)
    similar = store(similar_classes(docs, classes.where(F.col("kind") == SET)), "similar-lines")
    free_shuffles(docs.sparkSession)
    several = classes.where((F.col("copies") > 1) & (F.col("kind") < SHORT)).select("h1", "h2", F.col("d").alias("fd"), F.col("l").alias("fl"))
    later = lines.where(F.col("kind") < SHORT).select("h1", "h2", "d", "l").join(several, ["h1", "h2"]).where("d <> fd OR l <> fl").select("d", "l")
    gone = store(later.unionByName(similar).groupBy("d").agg(F.collect_set("l").alias("ls")), "repeated-lines")
    return store(_with_short(lines, classes, gone), "repeated-with-short") if short else gone


def dedup_lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """All columns of ``docs``, with ``text`` less its repeated lines, and ``n_lines``,
    ``n_removed`` (in place of columns that already have these names).

    A line of at least MIN_WORDS distinct words goes if an earlier line of the corpus, by
    doc_id and place, has a Jaccard similarity of 0.8 or more with it (whether or not that one
    goes too); one of fewer distinct words that is long (EXACT_WORDS, EXACT_CHARS) goes if it
    equals an earlier one. Short lines stay; with ``short`` those go that equal an earlier line
    and have nothing but removed lines next to them, short ones passed over. Null texts stay null and have no line; an empty text has
    one. Rows with one doc_id are one document: what is removed from one is removed from all.
    A null doc_id comes before all others.
    """
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    gone = repeated_lines(docs.select(place.alias("d"), "text"), short)
    rows = docs.select(place.alias("d"), "text", F.struct(*docs.columns).alias("row"))
    rows = rows.join(F.broadcast(gone) if _small(gone) else gone, "d", "left")
    left = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("ls", i))
    rows = rows.withColumn("new", F.when(F.col("ls").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
    columns = [F.col("new").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    n_lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(n_lines).cast("long")
    n_removed = F.when(F.col("ls").isNull(), 0).otherwise(F.size("ls")).cast("long")
    return rows.select(*columns, n_lines.alias("n_lines"), n_removed.alias("n_removed"))


def op9_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


#: The same by an independent prefix order (number of lines that hold the word, then the word).
SQL = """
WITH lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)
), sets AS (
  SELECT doc_id, line_no, line, list_filter(regexp_split_to_array(lower(line), '[ \\t\\x0b\\f\\r]+'), lambda w: w <> '') AS every,
    list_sort(list_distinct(every)) AS words
  FROM lines
), repeats AS (
  SELECT doc_id, line_no FROM sets
  WHERE len(words) BETWEEN 1 AND 4 AND (
    len(every) + length(regexp_replace(lower(line), '[^\\p{Han}\\p{Hiragana}\\p{Katakana}\\p{Thai}\\p{Lao}\\p{Khmer}\\p{Myanmar}]+', '', 'g')) >= 10
    OR length(regexp_replace(lower(line), '[ \\t\\x0b\\f\\r]+', '', 'g')) >= 60)
  QUALIFY row_number() OVER (PARTITION BY every ORDER BY doc_id, line_no) > 1
), classes AS (
  SELECT words, min((doc_id, line_no)) AS pos, len(words) AS n FROM sets WHERE len(words) >= 5 GROUP BY words
), tokens AS (
  SELECT pos, n, unnest(words) AS w FROM classes
), counted AS (
  SELECT w, count(*) AS df FROM tokens GROUP BY w
), ranked AS (
  SELECT pos, n, w, row_number() OVER (PARTITION BY pos ORDER BY df, w) AS i FROM tokens JOIN counted USING (w)
), prefixes AS (
  SELECT * FROM ranked WHERE i <= n - (80 * n + 99) // 100 + 1
), pairs AS (
  SELECT DISTINCT a.pos AS a, b.pos AS b FROM prefixes a JOIN prefixes b USING (w)
  WHERE a.pos < b.pos AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), alike AS (
  SELECT DISTINCT b AS pos FROM pairs JOIN classes x ON x.pos = a JOIN classes y ON y.pos = b
  WHERE 180 * len(list_intersect(x.words, y.words)) >= 80 * (x.n + y.n)
), kept AS (
  SELECT pos FROM classes ANTI JOIN alike USING (pos)
), judged AS (
  SELECT s.doc_id, s.line_no, s.line, k.pos IS NOT NULL OR len(s.words) < 5 AND r.doc_id IS NULL AS stays
  FROM sets s LEFT JOIN kept k ON k.pos = (s.doc_id, s.line_no) LEFT JOIN repeats r ON r.doc_id = s.doc_id AND r.line_no = s.line_no
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
  md5(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (stays), '')) AS text_md5
FROM judged GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
