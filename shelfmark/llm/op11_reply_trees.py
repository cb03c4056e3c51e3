"""Reply trees to conversations: root-to-leaf paths by iterative self-joins, ranked and formatted.

A message answers at most one other. Joining the table of replies to itself gives, round after
round, the 1st, 2nd, 4th, 8th ... ancestor of every message, with the sum of scores in between; so
the depth, the total and the end of every path are known after as many rounds as the depth has
binary digits. Leaves are ranked within their tree by the mean score of their path, and the chosen
paths are walked back over the same tables, the largest steps first, which lists every message of
a path once.

Each message becomes a marked turn, and turns are joined in parts of bounded length, so that a
path of any length is spread over many rows. The loss mask is a list of spans of characters, one
for each assistant text.

    ### role:
    text</turn>

Within a text ``\\``, ``#`` and ``</turn>`` take a ``\\`` before them; within a role ``:`` and line
feeds do so too. A turn therefore ends at the first ``</turn>`` that no ``\\`` takes away, and
everything can be read back.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.words import arrow_schema, store
from shelfmark.operators.ids import assign_ids
from shelfmark.session import scratch_path, ship_package

#: Turns of a part of a formatted conversation.
PART_TURNS = 64
#: The role whose texts are learned from.
ANSWERS = "assistant"

#: Fixed: what the template consists of.
OPEN, NAMED, CLOSE = "### ", ":\n", "</turn>"

_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+):\n((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escaped(text: Column) -> Column:
    """``text`` without control strings; null counts as empty."""
    slashes = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(slashes, F.lit("#"), F.lit("\\#")), F.lit(CLOSE), F.lit("\\" + CLOSE))


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def ancestors(replies: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(steps, paths) for replies (node, up, score), in which ``up`` is null or a node.

    ``steps[k]`` has (node, up) for the 2**k-th ancestor, where there is one. ``paths`` has (node,
    total, depth) for every node: sum of scores and number of messages from the root to it. Replies
    that run in a circle, and all replies to them, count as roots of their own, to whom nobody
    answers.
    """
    current = store(replies.select("node", "up", F.col("score").cast("double").alias("total"), F.lit(1).cast("long").alias("depth")), "replies-0")
    n, steps = current.count(), []
    while current.where("up IS NOT NULL").limit(1).count():
        if 1 << len(steps) > n:  # a path of more messages than there are
            circle = current.where("up IS NOT NULL").select("node", F.lit(True).alias("alone"))
            free = replies.join(circle, "node", "left").select("node", F.when(F.col("alone"), None).otherwise(F.col("up")).alias("up"), "score")
            return ancestors(free)
        steps.append(current.where("up IS NOT NULL").select("node", "up"))
        far = current.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"), F.col("depth").alias("deeper"))
        joined = current.where("up IS NOT NULL").join(far, "up")
        onward = joined.select("node", F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total"), (F.col("depth") + F.col("deeper")).alias("depth"))
        current = store(current.where("up IS NULL").unionByName(onward), f"replies-{len(steps)}")
    return steps, current.select("node", "total", "depth")


def choose_paths(messages: DataFrame, best: int) -> DataFrame:
    """(tree, path, rank, score, depth, node, pos): the messages of the ``best`` paths of each
    tree of ``messages`` (tree, node, up, score). A path is named by its leaf; ``pos`` counts from
    the root. Paths rank by mean score, then length, then leaf."""
    steps, paths = ancestors(messages.select("node", "up", "score"))
    leaves = messages.select("tree", "node")
    if steps:
        leaves = leaves.join(steps[0].select(F.col("up").alias("node")).distinct(), "node", "left_anti")
    ranked = leaves.join(paths, "node").withColumn("score", F.col("total") / F.col("depth"))
    order = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "node")
    chosen = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    chosen = store(chosen.select("tree", F.col("node").alias("path"), "rank", "score", "depth"), "paths")
    members = chosen.select("path", F.col("path").alias("node"), F.lit(0).cast("long").alias("steps"))
    for k in reversed(range(len(steps))):
        # Each message so far, and its 2**k-th ancestor: every number of steps comes up once.
        both = F.array(F.struct("node", "steps"), F.struct(F.col("up").alias("node"), (F.col("steps") + (1 << k)).alias("steps")))
        members = members.join(steps[k], "node", "left").select("path", F.inline_outer(both)).where("node IS NOT NULL")
        members = store(members, "path-members")
    return chosen.join(members, "path").select("tree", "path", "rank", "score", "depth", "node", (F.col("depth") - 1 - F.col("steps")).alias("pos"))


def format_paths(links: DataFrame, texts: DataFrame, best: int = 1) -> DataFrame:
    """Formatted conversations of ``links`` (tree, node, up, score) and ``texts`` (node, role, text),
    whose ``node`` is unique and whose ``up`` is null or the node of a message of the same tree:
    tree, path, rank, score, depth, part, text, loss (start, end) by part."""
    turns = choose_paths(links, best).join(texts, "node")
    name = F.replace(F.replace(escaped(F.col("role")), F.lit(":"), F.lit("\\:")), F.lit("\n"), F.lit("\\\n"))
    head, body = F.concat(F.lit(OPEN), name, F.lit(NAMED)), escaped(F.col("text"))
    learned = F.coalesce(F.col("role") == ANSWERS, F.lit(False))
    turn = F.struct("pos", F.concat(head, body, F.lit(CLOSE + "\n")).alias("shown"), F.length(head).alias("head"), F.length(body).alias("body"), learned.alias("learned"))
    part = F.floor(F.col("pos") / PART_TURNS).cast("int").alias("part")
    parts = turns.select("tree", "path", "rank", "score", "depth", part, turn.alias("turn"))
    parts = parts.groupBy("path", "part").agg(*[F.first(c).alias(c) for c in ("tree", "rank", "score", "depth")], F.array_sort(F.collect_list("turn")).alias("turns"))
    # Where each turn ends; a turn begins where the one before ends.
    ends = F.transform("turns", lambda t, i: F.aggregate(F.slice("turns", 1, i + 1), F.lit(0), lambda a, x: a + F.length(x["shown"])))
    closing = len(CLOSE) + 1
    spans = F.transform("turns", lambda t, i: F.struct(t["learned"].alias("learned"), (F.get("ends", i) - closing - t["body"]).alias("start"), (F.get("ends", i) - closing).alias("end")))
    parts = parts.withColumn("ends", ends).withColumn("spans", F.filter(spans, lambda s: s["learned"]))
    loss = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return parts.select("tree", "path", "rank", "score", "depth", "part", F.array_join("turns.shown", "").alias("text"), loss.alias("loss"))


def format_replies(messages: DataFrame, best: int = 1) -> DataFrame:
    """Conversations along the ``best`` branches of each tree of ``messages`` (tree, node, parent,
    role, text, score): tree, path, rank, score, depth, part, text, loss, one row per part of a
    conversation (``PART_TURNS`` turns).

    A parent that is null, or not in the same tree, makes a root. A null score counts as 0, a null
    text or role as empty; a null tree is one tree. Rows that are the same in all columns count
    once. Of different rows with one node the first (by role and text) is answered, and the others
    are leaves; so are rows without a node. Messages that answer in a circle, and all below them,
    stand alone. Ties of score go to the longer path, then to the order of (tree, node, role, text).
    Extra columns are not looked at; an empty table gives no row.
    """
    rows = messages.select("tree", "node", "parent", "role", "text", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")).distinct()
    rows = store(assign_ids(rows, ["tree", "node", "role", "text", "parent"], "row"), "messages")
    # A struct is never null, so null trees meet.
    tree = F.struct("tree").alias("t")
    named = rows.where("node IS NOT NULL").groupBy(tree, F.col("node").alias("parent")).agg(F.min("row").alias("up"))
    found = rows.select("row", tree, "parent").join(named, ["t", "parent"]).where("row <> up").select("row", "up")
    links = rows.select("row", "tree", "score").join(found, "row", "left").withColumnRenamed("row", "node")
    return format_paths(store(links, "links"), rows.select(F.col("row").alias("node"), "role", "text"), best)


def format_turns(turns: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``format_replies`` for conversations that are chains: rows of ``turns`` (with role and
    text) in the given order, each the answer to the one before it with the same ``tree``.

    Rows are numbered in that order over all conversations, and a row is joined to the next
    number: no conversation is gathered in one task, however long it is.
    """
    rows = turns.select(F.col(tree).alias("tree"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], "role", "text")
    rows = assign_ids(rows, ["tree", *[f"o{i}" for i in range(len(order))], "role", "text"], "node").select("node", "tree", "role", "text")
    before = rows.select((F.col("node") + 1).alias("node"), F.col("tree").alias("last"), F.col("node").alias("up"))
    links = rows.select("node", "tree").join(before, "node", "left")
    links = links.select("tree", "node", F.when(F.col("tree").eqNullSafe(F.col("last")), F.col("up")).alias("up"), F.lit(0.0).alias("score"))
    return format_paths(store(links, "links"), rows.select("node", "role", "text"))


def read_conversations(parts: DataFrame) -> DataFrame:
    """What formatted parts hold: tree, path, n_turns, turns_sha256 (role, line feed, text, line feed
    of each turn), loss_chars, loss_sha256 (texts under the mask), formatted_chars.

    Turns are told apart by the template alone and learned texts by the mask alone. Conversations
    of one part are read in place; the parts of longer ones pass by in order, one at a time.
    """
    ship_package(parts.sparkSession)
    schema = f"tree {parts.schema['tree'].dataType.simpleString()}, path long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    arrow = arrow_schema(schema)

    def read(batches):
        path, row, turns, loss = None, [], None, None
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("tree", "path", "text", "spans"))
            for tree, at, text, spans in zip(*columns, strict=True):
                if at != path:
                    if row:
                        out.append([*row[:3], turns.hexdigest(), row[3], loss.hexdigest(), row[4]])
                    path, row, turns, loss = at, [tree, at, 0, 0, 0], hashlib.sha256(), hashlib.sha256()
                end = 0
                for found in _TURN.finditer(text):
                    if found.start() != end:
                        break
                    end = found.end()
                    turns.update(f"{unescaped(found[1])}\n{unescaped(found[2])}\n".encode())
                    row[2] += 1
                if end != len(text):
                    raise ValueError(f"not a formatted conversation: path {at}, character {end}")
                for a, b in zip(spans[::2], spans[1::2], strict=True):
                    learned = unescaped(text[a:b])
                    loss.update(learned.encode())
                    row[3] += len(learned)
                row[4] += len(text)
            yield _batch(out, arrow)
        if row:
            yield _batch([[*row[:3], turns.hexdigest(), row[3], loss.hexdigest(), row[4]]], arrow)

    spans = F.flatten(F.transform("loss", lambda s: F.array(s["start"], s["end"]))).alias("spans")
    rows = parts.select("tree", "path", "depth", "part", "text", spans)
    short = rows.where(F.col("depth") <= PART_TURNS)
    long = rows.where(F.col("depth") > PART_TURNS).repartition("path").sortWithinPartitions("path", "part")
    fields = ("tree", "path", "text", "spans")
    return short.select(*fields).mapInArrow(read, schema).unionByName(long.select(*fields).mapInArrow(read, schema))


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


#: Fixed: a conversation whose texts hold the template's own marks.
TRICKY = "\\### Assistant: </turn> ok"


def op11_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    path = scratch_path(spark, "conversations")
    format_turns(turns.unionByName(tricky), "conv_id", ["turn"]).write.option("compression", "zstd").parquet(path)
    found = read_conversations(spark.read.parquet(path))
    return found.select(F.col("tree").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), known AS (
  SELECT conv_id, turn, role, coalesce(role, '') AS r, coalesce(text, '') AS t,
    coalesce(role = 'assistant', false) AS learned FROM turns
), marked AS (
  SELECT *, replace(replace(replace(t, '\', '\\'), '#', '\#'), '</turn>', '\</turn>') AS body,
    replace(replace(replace(replace(replace(r, '\', '\\'), '#', '\#'), '</turn>', '\</turn>'), ':', '\:'), chr(10), '\' || chr(10)) AS name
  FROM known
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (learned), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (learned), '')) AS loss_sha256,
  sum(length('### ' || name || ':' || chr(10) || body || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
