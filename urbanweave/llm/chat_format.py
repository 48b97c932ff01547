"""Conversations as one marked text per conversation, with attachments and a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values of the template. No escaped text holds "<", "[" or "|", so it can imitate neither these marks nor the
# control strings of other templates, all of which start with one of them.
OPEN, BODY, CLOSE = "<|", "|>\n", "<|end|>\n"
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"), ("|", "\\p"))

PART_TYPE = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
PATCH, TOKENS_PER_SECOND, TOKENS_PER_PAGE = 28, 25.0, 600


def escape(text: Column) -> Column:
    """Each special character becomes a backslash and a letter; the backslash goes first."""
    for mark, code in ESCAPES:
        text = F.replace(text, F.lit(mark), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for mark, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(mark))
    return text


def part_tokens(part: Column) -> Column:
    """Tokens that an attachment expands to: image patches, seconds of audio, pages of a document; 0 for text."""
    image = F.ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * TOKENS_PER_SECOND)
    document = F.coalesce(part["pages"], F.lit(0)) * TOKENS_PER_PAGE
    n = F.when(part["type"] == "image", image).when(part["type"] == "audio", audio)
    return F.coalesce(n.when(part["type"] == "document", document), F.lit(0)).cast("long")


def visit(parts: Column) -> Column:
    """Flatten typed parts in order: text escaped, each attachment a placeholder named after its type."""
    known = F.coalesce(parts, F.array().cast(PART_TYPE))
    known = F.filter(known, lambda p: p.isNotNull())
    attached = lambda p: F.coalesce(p["type"].isin("image", "audio", "document"), F.lit(False))
    body = F.transform(
        known,
        lambda p: F.when(attached(p), F.concat(F.lit(OPEN), p["type"], F.lit("|>"))).otherwise(
            escape(F.coalesce(p["text"], F.lit("")))
        ),
    )
    refs = F.transform(
        F.filter(known, attached),
        lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), part_tokens(p).alias("n_tokens")),
    )
    return F.struct(F.array_join(body, "").alias("body"), refs.alias("refs"))


def format_chat(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str | None = "text", parts_col: str | None = None, learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``id``, ``formatted``, ``loss_spans``, ``attachments``, ``attachment_tokens``.

    The content of a turn is ``parts_col`` (typed parts) or else ``text_col``. Turns follow ``turn_col`` (nulls first;
    ties by role, then text), repeated rows stay. A null role or text is empty, a part of unknown type is text, a null
    id makes one conversation of its own, an empty table gives an empty one. ``loss_spans`` holds start and length in
    code points of each body spoken by ``learn``; ``attachments`` the turn's place, type, reference and tokens in order.

    Only the columns named are read, so other names cannot clash. Places come from one window over the same key as the
    grouping, so there is a single shuffle; the turns of one conversation meet in one row because that row is the
    output.
    """
    content = F.col(parts_col).cast(PART_TYPE) if parts_col else F.array(
        F.struct(
            F.lit("text").alias("type"), F.col(text_col).alias("text"), F.lit(None).alias("ref"),
            F.lit(None).alias("width"), F.lit(None).alias("height"), F.lit(None).alias("seconds"),
            F.lit(None).alias("pages"),
        )
    ).cast(PART_TYPE)
    rows = turns.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), visit(content).alias("seen"),
    )
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(BODY))
    rows = rows.select(
        "id", "turn", "role", "seen.body", "seen.refs", head.alias("head"),
        F.concat(head, F.col("seen.body"), F.lit(CLOSE)).alias("piece"),
    )
    order = W.partitionBy("id").orderBy(F.asc_nulls_first("turn"), "role", "body")
    before = F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn("start", before + F.length("head"))
    spoken = F.struct(
        "place", "piece", (F.col("role") == learn).alias("learn"), F.col("start").cast("long").alias("start"),
        F.length("body").cast("long").alias("length"), "refs",
    )
    whole = rows.groupBy("id").agg(F.sort_array(F.collect_list(spoken)).alias("all"))
    marked = F.filter("all", lambda t: t["learn"])
    refs = F.flatten(
        F.transform(
            "all",
            lambda t: F.transform(
                t["refs"],
                lambda r: F.struct(
                    t["place"].alias("place"), r["type"].alias("type"), r["ref"].alias("ref"), r["n_tokens"].alias("n_tokens")
                ),
            ),
        )
    )
    return whole.select(
        "id",
        F.array_join(F.transform("all", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(marked, lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
        refs.alias("attachments"),
        F.aggregate(refs, F.lit(0).cast("long"), lambda n, r: n + r["n_tokens"]).alias("attachment_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text as an array of ``role`` and ``text``."""
    pieces = F.filter(F.split(formatted, "<\\|end\\|>\n"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring_index(p.substr(F.lit(3), F.length(p)), BODY, 1)).alias("role"),
            unescape(p.substr(F.instr(p, BODY) + 3, F.length(p))).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""
    cut = F.transform(spans, lambda s: formatted.substr(s["start"].cast("int") + 1, s["length"].cast("int")))
    return F.array_join(F.transform(cut, unescape), "")
