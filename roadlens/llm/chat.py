"""Operator 8: chat formatting of reply trees.

Messages form trees by their parent. Root-to-leaf paths come from self-joins
that double the length of the known path in every round, so a path of d
messages takes log2(d) joins. Each leaf is a branch; branches are ranked by
their mean message score, and each chosen branch becomes one conversation.

The template marks a turn as ``### <Role>: <text> </turn>`` and a newline. A
backslash before a control string escapes it: texts get one more backslash
before ``###`` and ``</turn>`` (and before backslashes that stand there), so
the text can be read back exactly. The loss mask covers the assistants' texts.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.llm.common import kept_table, read, ship_package

END = " </turn>\n"
CONTROL = re.compile(r"(\\*)(###|</turn>)")
ESCAPED = re.compile(r"\\(\\*(?:###|</turn>))")
#: A turn starts behind the last turn's end, at an unescaped mark.
ROLE = re.compile(r"### ([^:\n]*): ")


def escape(text: str) -> str:
    return CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the assistants' texts."""
    out, mask, at = [], [], 0
    for role, text in turns:
        head = f"### {escape_role(role)}: "
        body = escape(text)
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        out.append(head + body + END)
        at += len(out[-1])
    return "".join(out), mask


def escape_role(role: str) -> str:
    """Role names are capitalised; others stand behind ``=`` as they are. What
    would end a name is written as a percent code."""
    name = role.capitalize() if role.isascii() and role.isalpha() and role.islower() else "=" + role
    return re.sub(r"[%:\n#</\\]", lambda m: f"%{ord(m[0]):x};", name)


def unescape_role(name: str) -> str:
    plain = re.sub("%([0-9a-f]+);", lambda m: chr(int(m[1], 16)), name)
    return plain[1:] if plain[:1] == "=" else plain.lower()


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns back from a formatted conversation. An escaped end has a
    backslash before it, so the next bare end closes the turn."""
    turns, at = [], 0
    while at < len(formatted):
        head = ROLE.match(formatted, at)
        end = formatted.index(END, head.end())
        turns.append((unescape_role(head[1]), unescape(formatted[head.end():end])))
        at = end + len(END)
    return turns


def climbs(start: DataFrame) -> tuple[list[DataFrame], DataFrame, DataFrame | None]:
    """Written tables of jumps, the k-th one 2^k parents up; the messages that
    have reached their root, with the ``points`` and number (``n``) of messages
    on the way; and the messages left if some parents form cycles, with the
    ``least`` id met.

    ``start``: rows (``tree``, ``id``, ``to``, ``points``), ``to`` null at a root.
    A round joins the messages that still climb with the places they stand at:
    jump, sums and least id double together. In a tree fewer messages climb in
    every round. Once as many do as before, all of them are on a cycle or lead to
    one, and once the least ids stand still too, a message on a cycle knows its
    least id."""
    state = start.withColumns({"n": F.lit(1).cast("long"), "least": F.col("to"), "lower": F.col("to").isNotNull()})
    jumps, settled, before = [], None, None
    while True:
        state = kept_table(state, "climbs")
        ended, climbing = state.filter("to IS NULL"), state.filter("to IS NOT NULL")
        settled = ended if settled is None else settled.unionByName(ended)
        left = climbing.agg(F.count(F.lit(1)).alias("n"), F.count_if("lower").alias("lower")).first()
        if not left.n:
            return jumps, settled, None
        if left.n == before and not left.lower:
            return jumps, settled, climbing
        jumps.append(climbing.select("tree", "id", "to"))
        before = left.n
        above = settled.unionByName(climbing).select(
            "tree", F.col("id").alias("to"), F.col("to").alias("far"), F.col("points").alias("p"), F.col("n").alias("m"),
            F.col("least").alias("then"))
        state = climbing.drop("lower").join(above, ["tree", "to"]).select(
            "tree", "id", F.col("far").alias("to"), (F.col("points") + F.col("p")).alias("points"),
            (F.col("n") + F.col("m")).alias("n"), F.least("least", "then").alias("least"),
            F.coalesce(F.col("then") < F.col("least"), F.lit(False)).alias("lower"))


def paths(messages: DataFrame, per_tree: int) -> DataFrame:
    """Rows (tree, leaf, id, up) of the ``per_tree`` best branches of every
    tree, one per message on the leaf's path, ``up`` steps from the leaf: by mean
    score of the path's messages (to a millionth), then length, then leaf.

    Branches are ranked before any is listed: sums and lengths up to the root
    double with the jumps, so a tree of n messages takes n log n rows, and only
    the chosen branches are unfolded. A cycle of parents is cut: the message of
    its least id starts a tree."""
    # Sums are wider than a score: they run around a cycle until it is found.
    points = F.coalesce(F.expr("try_cast(round(score * 1000000) AS bigint)"), F.lit(0)).cast("decimal(38,0)")
    ids = messages.select("tree", F.col("id").alias("parent"), F.lit(True).alias("held"))
    edges = messages.select("tree", "id", "parent", points.alias("points")).join(ids, ["tree", "parent"], "left").select(
        "tree", "id", F.when(F.col("held"), F.col("parent")).alias("to"), "points")
    jumps, total, looped = climbs(edges)
    if looped is not None:
        starts = looped.filter("id = least").select("tree", "id", F.lit(True).alias("first"))
        edges = kept_table(edges, "edges").join(starts, ["tree", "id"], "left").select(
            "tree", "id", F.when(F.col("first").isNull(), F.col("to")).alias("to"), "points")
        jumps, total, _ = climbs(edges)
    leaves = total.select("tree", "id", F.col("points").cast("double").alias("points"), "n")
    if jumps:
        leaves = leaves.join(jumps[0].select("tree", F.col("to").alias("id")), ["tree", "id"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc(F.col("points") / F.col("n")), F.desc("n"), "id")
    path = (leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= per_tree)
            .select("tree", F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("up")))
    for k, jump in enumerate(jumps):  # paths of 2^k messages are known; jumps go 2^k up
        further = path.join(jump, ["tree", "id"]).select("tree", "leaf", F.col("to").alias("id"),
                                                         (F.col("up") + (1 << k)).alias("up"))
        path = kept_table(path.unionByName(further), "paths")
    return path


def conversations(messages: DataFrame, *, per_tree: int = 1) -> DataFrame:
    """Rows (tree, leaf, formatted, mask) of the chosen branches of messages
    (``tree``, ``id``, ``parent``, ``role``, ``text``, ``score``). Null roles
    and texts are empty, null or NaN scores 0. Of messages that repeat an id
    the one of least parent, role, text and score counts. A parent that the tree
    doesn't hold starts one, and so does the least id of a cycle. A message
    without an id is not part of a tree. An empty table gives no rows."""
    ship_package(messages.sparkSession)
    messages = messages.groupBy("tree", "id").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m")).select("tree", "id", "m.*")
    messages = kept_table(messages.filter("id IS NOT NULL"), "messages")
    chosen = paths(messages, per_tree)
    turns = (chosen.join(messages.select("tree", "id", F.coalesce("role", F.lit("")).alias("role"),
                                         F.coalesce("text", F.lit("")).alias("text")), ["tree", "id"])
             .groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct("up", "role", "text")), asc=False)
                                          .alias("turns")))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def batches(it):
        for batch in it:
            done = [format_turns([(t["role"], t["text"]) for t in row.as_py()]) for row in batch.column("turns")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("leaf"), pa.array([x for x, _ in done], pa.string()),
                 pa.array([[{"start": a, "end": b} for a, b in m] for _, m in done], span)],
                ["tree", "leaf", "formatted", "mask"])

    kinds = dict(turns.dtypes)
    return turns.mapInArrow(batches, f"tree {kinds['tree']}, leaf {kinds['leaf']}, formatted string, "
                                     "mask array<struct<start: int, end: int>>")


def chained(rows: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """A table of turns as messages: each turn answers the one before it.
    Turns that tie are ordered by role and text and follow each other; a null
    turn comes first; a null conversation id is a conversation of its own."""
    base = rows.select(F.col(id_col).alias("tree"), F.col(turn_col).alias("__turn"),
                       F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    place = Window.partitionBy("tree").orderBy("__turn", "role", "text")
    return (base.withColumn("id", F.row_number().over(place).cast("long"))
            .select(F.struct(F.col("tree").alias("of")).alias("tree"), "id",
                    F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text",
                    F.lit(0.0).alias("score")))


PROBE_ID = -7
PROBE = r"\### Assistant: </turn> ok"


def op8_reply_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE), (PROBE_ID, 1, "assistant", PROBE)],
                                  "conv_id long, turn int, role string, text string")
    kinds = dict(rows.dtypes)
    probe = probe.select(*[F.col(c).cast(kinds[c]) for c in rows.columns])
    formatted = conversations(chained(rows.unionByName(probe)))

    def batches(it):
        for batch in it:
            out = []
            for text, mask in zip(batch.column("formatted").to_pylist(), batch.column("mask").to_pylist()):
                turns = read_turns(text)
                lost = "".join(unescape(text[m["start"]:m["end"]]) for m in mask)
                out.append((len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                            len(lost), hashlib.sha256(lost.encode()).hexdigest(), len(text)))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree").field(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64())],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(batches, f"conv_id {kinds['conv_id']}, n_turns long, turns_sha256 string, "
                                         "loss_chars long, loss_sha256 string, formatted_chars long")


def _oracle() -> str:
    """Texts are escaped by one backslash before each control string."""
    text = "coalesce(text, '')"
    escaped = f"length({text}) + len(regexp_extract_all({text}, '###|</turn>'))"
    named = "CASE WHEN regexp_full_match(coalesce(role, ''), '[a-z]+') THEN length(role) ELSE 1 + length(coalesce(role, '')) END"
    probe = PROBE.replace("'", "''")
    return f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT {PROBE_ID}, 0, 'user', '{probe}' UNION ALL SELECT {PROBE_ID}, 1, 'assistant', '{probe}'),
a AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(coalesce(role, '') || chr(10) || {text} || chr(10), '' ORDER BY turn, role, text) AS turns,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN {text} END, '' ORDER BY turn, role, text), '') AS lost,
  sum(4 + {named} + 2 + {escaped} + {len(END)}) AS formatted FROM c GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256,
  CAST(length(lost) AS BIGINT) AS loss_chars, sha256(lost) AS loss_sha256, CAST(formatted AS BIGINT) AS formatted_chars
FROM a
"""


ORACLE_SQL = _oracle()
