"""Spelling variants by a relational trie frontier.

The vocabulary is a trie held as a table of nodes with their edges (symbol,
follow): a node is a prefix, `follow` the symbols that may come after the edge,
END among them where a word ends. States (word, position, node, edits) are joined with
the edges level by level - a level is a node's length - and each join consumes
a symbol, replaces it or inserts one; deletions need no edge. After the edit
the rest of the word must follow edges exactly, and a state that reaches END
with one edit names a neighbour.

Two tries keep the frontier small: of two words that differ by one edit, the
edit lies in the second half of the word or, read backwards, in the second
part of the reversed word. States therefore start in the middle of the word,
where the exact path is known, and below it a node has few edges. `follow`
looks one symbol ahead, so an edit that the next symbol contradicts makes no
state. An edit inside a run of one letter is made at the run's end only.

Words of more than LEVELS code points don't walk the trie: those that differ
by one edit share their first or last half exactly, which is their join key,
and the edit distance decides.

Every level is one shuffle of its own states and edges; levels are staged, so
the plan of one level never holds the ones before.

Defined results: NULL and empty texts have no words; a NULL doc_id counts as
the empty string in the deletion rule; repeated rows count as often as they
occur; ties of n go to the smaller word in code-point order; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import stage, table

#: Fixed values of the contract.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
EDIT_SHARE = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form occurs so many times as often as its variants.
LEAD = 2

#: Symbol behind the last letter of a word; no letter.
END = "$"
#: Longest words that walk the trie.
LEVELS = 64

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the words of whole texts, one code point of every 97th occurrence deleted."""
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("run"),
    ).select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % EDIT_SHARE == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def _symbol(rest) -> F.Column:
    """The first symbol of what is left of a word."""
    return F.when(rest == "", END).otherwise(F.substring(rest, 1, 1))


def _sided(words: DataFrame) -> DataFrame:
    """side, spelled (backwards on side 1), start: the words of both tries and the depth at which edits begin."""
    half = F.floor(F.length("word") / 2).cast("int")
    forth = words.select(F.lit(0).alias("side"), F.col("word").alias("spelled"), half.alias("start"))
    back = words.select(F.lit(1).alias("side"), F.reverse("word").alias("spelled"), (F.length("word") - half).alias("start"))
    return forth.unionByName(back)


def trie_nodes(words: DataFrame) -> DataFrame:
    """depth, side, node, edges (symbol, follow): the edges of nodes at which an edit can begin, of both tries.
    A node has an edge for each letter at most."""
    least = LEAST_LENGTH // 2
    sided = _sided(words)
    prefixes = sided.select(
        "side", F.explode(F.sequence(F.lit(least + 1), F.length("spelled"))).alias("at"), "spelled",
    ).select("side", F.substring("spelled", F.lit(1), F.col("at")).alias("child"), _symbol(F.substring("spelled", F.col("at") + 1, F.lit(1))).alias("next"))
    follow = prefixes.groupBy("side", "child").agg(F.concat_ws("", F.collect_set("next")).alias("follow"))
    length = F.length("child")
    inner = follow.select("side", F.substring("child", F.lit(1), length - 1).alias("node"), F.substring("child", length, F.lit(1)).alias("symbol"), "follow")
    ends = sided.select("side", F.col("spelled").alias("node"), F.lit(END).alias("symbol"), F.lit("").alias("follow"))
    return inner.unionByName(ends).groupBy("side", "node").agg(F.collect_list(F.struct("symbol", "follow")).alias("edges")).withColumn("depth", F.length("node"))


def _level(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """From the states (side, word, rest, node, edits) at nodes of one depth, those one level deeper;
    `ended` ones have reached END with one edit, at the neighbour `node`."""
    rest = F.col("rest")
    after = F.substring("rest", F.lit(2), F.length("rest"))
    here, ahead = _symbol(rest), _symbol(after)
    # of equal letters in a row, the last one is deleted
    deleted = states.where((F.col("edits") == 0) & (rest != "") & (here != ahead)).select("side", "word", after.alias("rest"), "node", F.lit(1).alias("edits"))
    met = states.unionByName(deleted).join(nodes, ["side", "node"]).select("side", "word", "rest", "node", "edits", F.inline("edges"))
    symbol, fresh, end = F.col("symbol"), F.col("edits") == 0, F.col("symbol") == END
    exact = symbol == here
    onward = F.contains("follow", ahead)
    consumed = F.when(end, exact & ~fresh).otherwise(F.when(exact, fresh | onward).otherwise(fresh & (rest != "") & onward))  # met or replaced
    inserted = fresh & ~exact & ~end & F.contains("follow", here)
    taken = met.withColumns({"consumed": consumed, "inserted": inserted}).where("consumed or inserted").withColumn(
        "way", F.explode(F.array(F.lit(True), F.lit(False)))).where(F.when(F.col("way"), F.col("consumed")).otherwise(F.col("inserted")))
    return taken.select(
        "side", "word", F.when(F.col("way"), after).otherwise(rest).alias("rest"), F.when(end, F.col("node")).otherwise(F.concat("node", symbol)).alias("node"),
        F.when(F.col("way") & exact, F.col("edits")).otherwise(1).alias("edits"), end.alias("ended"))


def _long_pairs(words: DataFrame) -> DataFrame:
    """word, near: neighbours of which at least one is longer than LEVELS, by a half that they share."""
    long = words.where(F.length("word") >= LEVELS)
    keyed = long.select("word", F.explode(F.array(F.length("word") - 1, F.length("word"))).alias("m")).select(
        "word", F.explode(F.array(
            F.struct("m", F.lit(0).alias("side"), F.expr("left(word, int(m / 2))").alias("half")),
            F.struct("m", F.lit(1).alias("side"), F.expr("right(word, int(m - int(m / 2)))").alias("half")),
        )).alias("key"))
    pairs = keyed.join(keyed.withColumnRenamed("word", "near"), "key")
    far = F.greatest(F.length("word"), F.length("near"))
    return pairs.where((far > LEVELS) & (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)).select("word", "near")


def neighbours(words: DataFrame) -> DataFrame:
    """word, near: all ordered pairs of staged `words` (word, ...) that differ by exactly one edit."""
    spark = words.sparkSession
    walkers = words.where(F.length("word") <= LEVELS).select("word")
    nodes = stage(trie_nodes(walkers), "trie-nodes", by="depth")
    starts = stage(_sided(walkers), "trie-starts", by="start")
    kinds = "side int, word string, rest string, node string, edits int"
    states, pairs = spark.createDataFrame([], kinds), spark.createDataFrame([], "side int, word string, near string")
    last = nodes.agg(F.max("depth")).first()[0] or 0
    for depth in range(LEAST_LENGTH // 2, last + 1):
        start = F.lit(depth)
        entering = starts.where(F.col("start") == depth).select(
            "side", F.col("spelled").alias("word"), F.substring("spelled", start + 1, F.length("spelled")).alias("rest"),
            F.substring("spelled", F.lit(1), start).alias("node"), F.lit(0).alias("edits"))
        # the next frontier and the neighbours are written together
        level = stage(_level(states.unionByName(entering), nodes.where(F.col("depth") == depth).drop("depth")), "trie-level", by="ended")
        states = level.where("not ended").drop("ended")
        pairs = pairs.unionByName(level.where("ended").select("side", "word", F.col("node").alias("near")))
    forth = lambda c: F.when(F.col("side") == 1, F.reverse(c)).otherwise(F.col(c)).alias(c)
    return pairs.select(forth("word"), forth("near")).unionByName(_long_pairs(words)).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where each word's forms end, by doubling: n grows along a chain, so chains end."""
    known = stage(forms.select("word", F.coalesce("form", "word").alias("root")), "variant-roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        known = stage(known.join(ahead, "root").select("word", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")), "variant-roots")
        if known.where("moved").isEmpty():
            return known.select("word", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = stage(vocabulary(docs, doc_id, text), "variant-words")
    pairs = stage(neighbours(words), "variant-pairs")
    best = (
        pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
        .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    )
    leads = -F.col("top.less") >= LEAD * F.col("n")
    forms = stage(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(leads, F.col("top.near")).alias("form"), F.when(leads, -F.col("top.less")).alias("form_n")),
        "variant-forms")
    return forms.join(roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")


def op11(spark, sf_dir) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
