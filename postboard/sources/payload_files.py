r"""Feed payloads from files, read by many tasks inside one file.

    <path>/board_ref=<board>/<any name>      one JSON payload each; Spark passes over files of no bytes
    <path>/<any name>                        packed: many payloads each, as `write_packed` leaves them

A payload of a gigabyte is more than a row should hold, and JSON has no record ends to split at. So files are read as pieces that
end at each `}`. Whether a piece begins inside a string follows from the number of quotes before it, and its depth from the
brackets before it; both are running sums, made within each split of a payload and carried over the splits. Then pieces know which
item of the list they belong to, and only the pieces of one item come together. All of it is column expressions.

A folder per board costs a file to open, to commit and to list per board, however short its payload. Packed files are as many as
tasks write; a payload in them begins at a character that no JSON holds, so that a broken one ends where the next begins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postboard.tables import materialise

#: A payload: its file, and its number in there.
UNIT = ["file", "rec"]
#: Begins each payload of a packed file. JSON escapes it in strings and allows it nowhere else.
MARK = "\x1e"
SPACES = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class PayloadFiles:
    """A folder of payload files, in place of a frame of payloads."""

    spark: SparkSession
    path: str
    packed: bool = False


def write_packed(payloads: DataFrame, path: str) -> None:
    """Payloads as packed files: MARK, the board's name, a line end, the payload, a line end. A payload that holds MARK is no JSON,
    and none with another control character in its place."""
    board = F.coalesce(F.url_encode("board_ref"), F.lit(""))
    payload = F.replace(F.coalesce("payload", F.lit("")), F.lit(MARK), F.lit("\x01"))
    payloads.select(F.concat(F.lit(MARK), board, F.lit("\n"), payload).alias("value")).write.text(path)


def depth_of(structure: Column) -> Column:
    """Opening less closing brackets."""
    n = lambda c: F.octet_length(structure) - F.octet_length(F.replace(structure, F.lit(c), F.lit("")))
    return n("{") + n("[") - n("]") - n("}")


def quoted_parts(text: Column) -> Column:
    """A text cut at its quotes, those after a backslash left out: in turn outside and inside of strings, or the other way round."""
    return F.split(F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit("")), '"')


def depth_change(parts: Column, first: int) -> Column:
    """By how much the parts that are outside of strings change the depth: every second one, from the first (0) or second (1)."""
    return depth_of(F.array_join(F.filter(parts, lambda _, i: i % 2 == first), ""))


def opened(text: Column, what: str) -> Column:
    """Whether a text begins with an object, after a comma or not (first), or with the list's end (ends)."""
    lead = F.ltrim(text, F.lit(SPACES))
    if what == "ends":
        return F.startswith(lead, F.lit("]"))
    return F.startswith(F.when(F.startswith(lead, F.lit(",")), F.ltrim(F.substr(lead, F.lit(2)), F.lit(SPACES))).otherwise(lead), F.lit("{"))


def parts(files: PayloadFiles) -> DataFrame:
    """(file, split, size, bytes, closed, begins, board_ref, text): what is read up to each `}`, in packed files cut at MARK as well.
    bytes are those read, with the end, and stand in the first part; an end closes the last."""
    read = files.spark.read.schema("value string" if files.packed else "value string, board_ref string").option("lineSep", "}").text(files.path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("_metadata.file_size").alias("size")]
    n_bytes = F.octet_length("value").cast("long") + 1
    if not files.packed:
        return read.select(*place, n_bytes.alias("bytes"), F.lit(True).alias("closed"), F.lit(False).alias("begins"), "board_ref", F.col("value").alias("text"))
    cut = F.when(F.contains("value", F.lit(MARK)), F.split("value", MARK)).otherwise(F.array("value"))
    rows = read.select(*place, n_bytes.alias("_bytes"), cut.alias("_cut")).select("*", F.posexplode("_cut").alias("_part", "_text"))
    begins, name = F.col("_part") > 0, F.substring_index("_text", "\n", 1)
    return rows.select(
        "file", "split", "size", F.when(begins, 0).otherwise(F.col("_bytes")).alias("bytes"), (F.col("_part") == F.size("_cut") - 1).alias("closed"), begins.alias("begins"),
        F.when(begins & (name != ""), F.url_decode(name)).alias("board_ref"), F.when(begins, F.substr("_text", F.instr("_text", "\n") + 1)).otherwise(F.col("_text")).alias("text"),
    )


def pieces(files: PayloadFiles) -> DataFrame:
    """Adds seq, quotes, d_out and d_in to the parts: their order in a split, the quotes in them, and by how much each changes the
    depth if it begins outside or inside of a string. No escape reaches over an end."""
    rows = parts(files).select("*", F.monotonically_increasing_id().alias("seq"), quoted_parts(F.col("text")).alias("_parts"))
    return rows.select("*", (F.size("_parts") - 1).alias("quotes"), depth_change(F.col("_parts"), 0).alias("d_out"), depth_change(F.col("_parts"), 1).alias("d_in")).drop("_parts")


def openings(rows: DataFrame, root: str) -> DataFrame:
    """Adds to pieces where the list may open: under its key, or with the payload's first character. head is the length up to
    there, h_out and h_in the change of depth; of the text and of what follows head: whether an object or the list's end is first."""
    head = F.when(F.contains("text", F.lit(f'"{root}"')), F.regexp_extract("text", rf'(?s)^(.*?"{root}"\s*:\s*\[)', 1)).otherwise("") if root else F.regexp_extract("text", r"(?s)^(\s*\[)", 1)
    rows = rows.withColumn("_head", head)
    found = lambda c: F.when(F.col("_head") != "", c)
    before, rest = quoted_parts(F.col("_head")), F.substr("text", F.length("_head") + 1)
    return rows.select(
        "*", F.length("_head").alias("head"), found(depth_change(before, 0)).alias("h_out"), found(depth_change(before, 1)).alias("h_in"),
        *[opened(F.col("text"), what).alias(f"text_{what}") for what in ("first", "ends")], *[found(opened(rest, what)).alias(f"rest_{what}") for what in ("first", "ends")],
    ).drop("_head")


def carried(rows: DataFrame, value: Column, name: str, unit: list[str]) -> DataFrame:
    """Adds the sum of a value over the pieces of the unit before each: within its split, and that of the splits before."""
    rows = rows.withColumn("_v", value.cast("long"))
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*unit, "split").agg(F.sum("_v").alias("_n"))
    totals = totals.select(*unit, "split", F.coalesce(F.sum("_n").over(ahead(Window.partitionBy(*unit).orderBy("split"))), F.lit(0)).alias("_before"))
    local = F.coalesce(F.sum("_v").over(ahead(Window.partitionBy(*unit, "split").orderBy("seq"))), F.lit(0))
    rows = rows.withColumn("_local", local).join(totals, [*unit, "split"])
    return rows.withColumn(name, F.col("_local") + F.col("_before")).drop("_v", "_local", "_before")


def numbered(rows: DataFrame, packed: bool) -> DataFrame:
    """Adds rec, the number of the payload in its file."""
    if not packed:
        return rows.withColumn("rec", F.lit(0).cast("long"))
    rows = carried(rows, F.col("begins").cast("long"), "_begun", ["file"])
    return rows.withColumn("rec", F.col("_begun") + F.col("begins").cast("long")).drop("_begun").filter("rec > 0")


def item_texts(files: PayloadFiles, root: str) -> tuple[DataFrame, DataFrame]:
    """(board_ref, file, rec, pos, raw) of all items of the lists under `root` (the payload itself where that is blank), and
    (board_ref, file, rec, listed, odd): per payload, whether it is whole and has its list, and whether the list holds anything
    but objects. Texts wait in the pieces until it is known which of them make up an item."""
    level = 2 if root else 1
    rows = materialise(openings(pieces(files), root), "pieces")
    # the last piece of a file was ended by nothing where pieces and ends together have one byte more than the file
    sizes = rows.groupBy("file").agg(F.sum("bytes").alias("_bytes"), F.max(F.struct("split", "seq")).alias("_last"))
    ended = F.col("closed") & ((F.col("_bytes") == F.col("size")) | (F.struct("split", "seq") != F.col("_last")))
    narrow = numbered(rows.drop("text").join(sizes, "file").withColumn("ended", ended).drop("_bytes", "_last", "bytes", "size", "closed"), files.packed)
    narrow = carried(narrow, F.col("quotes"), "_quotes", UNIT).withColumn("inside", F.col("_quotes") % 2 == 1)
    closing = F.col("ended") & ((F.col("_quotes") + F.col("quotes")) % 2 == 0)
    step = F.when(F.col("inside"), F.col("d_in")).otherwise(F.col("d_out")) - closing.cast("int")
    narrow = carried(narrow.withColumn("step", step), F.col("step"), "depth", UNIT)
    at = F.col("depth") + F.when(F.col("inside"), F.col("h_in")).otherwise(F.col("h_out"))
    narrow = narrow.withColumn("opens", (F.col("head") > 0) & F.coalesce(at == level, F.lit(False)) & (F.col("depth") < level))
    begins = lambda what: F.when(F.col("opens"), F.col(f"rest_{what}")).otherwise((F.col("depth") == level) & ~F.col("inside") & F.col(f"text_{what}"))
    df = materialise(narrow.select("board_ref", *UNIT, "split", "seq", "head", "ended", "step", "depth", "opens", begins("first").alias("first"), begins("ends").alias("closes")), "placed_pieces")
    spot = F.struct("split", "seq")
    lists = df.groupBy(*UNIT).agg(F.min("board_ref").alias("board_ref"), F.min(F.when(F.col("opens"), spot)).alias("start"), F.sum("step").alias("left"))
    # merged: as files these rows are a few bytes each, in a broadcast a path each
    ends = df.join(lists.select(*UNIT, "start").hint("merge"), UNIT).filter(F.col("closes") & (spot >= F.col("start"))).groupBy(*UNIT).agg(F.min(spot).alias("end"))
    lists = lists.join(ends, UNIT, "left")
    lists = materialise(lists.withColumn("listed", F.coalesce((F.col("left") == 0) & F.col("start").isNotNull(), F.lit(False))), "lists")
    bounds = lists.filter("listed and end is not null").select(*UNIT, "board_ref", "start", "end").hint("merge")
    inner = df.drop("board_ref").join(bounds, UNIT).filter((spot >= F.col("start")) & (spot < F.col("end")) & ((F.col("depth") >= level) | F.col("opens")))
    odd = inner.filter("not first and (opens or depth = %d)" % level).select(*UNIT).distinct().withColumn("odd", F.lit(True))
    inner = carried(inner.drop("start", "end"), F.col("first").cast("int"), "_seen", UNIT).withColumn("pos", F.col("_seen") + F.col("first").cast("int") - 1)
    inner = inner.select("board_ref", *UNIT, "split", "seq", "head", "ended", "opens", "first", "pos").join(rows.select("seq", "text"), "seq")
    rest = F.when(F.col("opens"), F.substr("text", F.col("head") + 1)).otherwise(F.col("text"))
    piece = F.concat(F.when(F.col("first"), F.substr(rest, F.instr(rest, "{"))).otherwise(F.col("text")), F.when(F.col("ended"), "}").otherwise(""))
    found = inner.groupBy("board_ref", *UNIT, "pos").agg(F.array_sort(F.collect_list(F.struct("split", "seq", piece.alias("text")))).alias("parts"))
    texts = found.select("board_ref", *UNIT, "pos", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("raw"))
    # a list that is closed, but not at the beginning of a piece, ends with something other than an object
    return texts, lists.join(odd, UNIT, "left").select("board_ref", *UNIT, "listed", (F.col("listed") & (F.coalesce("odd", F.lit(False)) | F.col("end").isNull())).alias("odd"))
