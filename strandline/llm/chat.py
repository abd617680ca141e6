"""Chat formatting with Spark expressions only.

Turn structs are collected per conversation, sorted, adjacent turns of one role are
merged into one marked message, and the text is concatenated. Control strings inside
texts and roles get a backslash after their first character (one more if there are
some already), so that no text can end a message and every text can be read back.

Cases: a null text or role is empty; a null turn sorts first; rows that tie on the turn
are ordered by role, then text, as they came in; repeated rows are all kept; null conv_ids
form one conversation; an empty table gives no row; other columns are ignored.

A conversation is one row, however many turns it has. Work on it grows in proportion to
its size: running positions are summed within runs of RUN pieces and then over the runs,
and spans are read from chunks of CHUNK code points.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = 256  #: pieces whose positions are summed in one fold
CHUNK = 4096  #: code points of a part of the text that spans are cut from


@dataclass(frozen=True)
class Template:
    start: str = "<|im_start|>"
    role_end: str = "<|im_sep|>"
    joint: str = "<|im_seg|>"  #: between the texts of merged turns
    end: str = "<|im_end|>"
    #: Further strings that tokenizers take as control tokens; escaped too.
    foreign: tuple[str, ...] = field(default=("<s>", "</s>", "[INST]", "[/INST]", "<SYS>>", "</SYS>>", "<|endoftext|>"))
    loss_roles: tuple[str, ...] = ("assistant",)

    def _tails(self) -> str:
        own = (self.start, self.role_end, self.joint, self.end, *self.foreign)
        for c in own:
            if c[0] not in "<[" or set(c[1:]) & set("<[\\"):
                raise ValueError(f"a control string starts with < or [ and holds no other of these, and no backslash: {c!r}")
        quote = lambda s: "".join("\\" + ch if ch in r"|/[](){}.*+?^$" else ch for ch in s)
        return "|".join(sorted({quote(c[1:]) for c in own}, key=lambda s: (-len(s), s)))

    @property
    def escape_pattern(self) -> str:
        return rf"([<\[])(\\*)({self._tails()})"

    @property
    def unescape_pattern(self) -> str:
        return rf"([<\[])\\(\\*)({self._tails()})"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self.escape_pattern), F.lit(r"$1$2\\$3"))

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, F.lit(self.unescape_pattern), F.lit("$1$2$3"))


def format_conversations(
    df: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, formatted (the whole text), loss_spans (array of start and length in code points, from 0)."""
    t = template
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    row = F.struct(F.col(f"`{turn_col}`").alias("turn"), plain(role_col).alias("role"), plain(text_col).alias("text"))
    turns = df.groupBy(F.col(f"`{conv_col}`").alias("conv_id")).agg(F.array_sort(F.collect_list(row)).alias("turns"))
    turn = F.col("turns")

    def piece(x: Column, i: Column) -> Column:
        header = F.concat(F.lit(t.start), t.escape(x["role"]), F.lit(t.role_end))
        joint = (
            F.when(i == 0, header)
            .when(F.get(turn, i - 1)["role"] == x["role"], F.lit(t.joint))
            .otherwise(F.concat(F.lit(t.end), header))
        )
        return F.struct(joint.alias("joint"), t.escape(x["text"]).alias("text"), x["role"].isin(*t.loss_roles).alias("loss"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["joint"])
        size = F.length(p["text"])
        span = F.struct(start.alias("start"), size.alias("length"))
        spans = F.when(p["loss"], F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((start + size).alias("at"), spans.alias("spans"))

    pieces = turns.select("conv_id", F.transform(turn, piece).alias("pieces"))
    none = F.expr("struct(0 AS at, CAST(array() AS array<struct<start: int, length: int>>) AS spans)")
    starts = F.sequence(F.lit(1), F.size("pieces"), F.lit(RUN))
    runs = F.transform(starts, lambda i: F.aggregate(F.slice("pieces", i, F.lit(RUN)), none, step))
    joined = F.array_join(F.transform("pieces", lambda p: F.concat(p["joint"], p["text"])), "")
    formatted = pieces.select("conv_id", F.concat(joined, F.lit(t.end)).alias("formatted"), runs.alias("runs"))
    begin = F.expr("struct(0 AS at, CAST(array() AS array<int>) AS begins)")
    begins = F.aggregate(
        "runs", begin, lambda acc, r: F.struct((acc["at"] + r["at"]).alias("at"), F.array_append(acc["begins"], acc["at"]).alias("begins")), lambda acc: acc["begins"]
    )
    shifted = F.zip_with(
        "runs", "begins", lambda r, at: F.transform(r["spans"], lambda s: F.struct((s["start"] + at).alias("start"), s["length"].alias("length")))
    )
    return formatted.withColumn("begins", begins).select("conv_id", "formatted", F.flatten(shifted).alias("loss_spans"))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, n_messages, turns (array of role and text, as they went in), loss_text, formatted_chars; all read from the formatted text."""
    t = template
    quote = lambda s: r"\Q" + s + r"\E"
    messages = F.filter(F.split("formatted", quote(t.end)), lambda m: m != "")
    parts = F.transform(messages, lambda m: F.split(F.substr(m, F.lit(len(t.start) + 1)), quote(t.role_end)))
    turns = F.flatten(
        F.transform(
            parts,
            lambda p: F.transform(
                F.split(F.get(p, F.lit(1)), quote(t.joint)),
                lambda x: F.struct(t.unescape(F.get(p, F.lit(0))).alias("role"), t.unescape(x).alias("text")),
            ),
        )
    )
    chunks = F.regexp_extract_all("formatted", F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))

    def cut(s: Column) -> Column:
        first, offset = (s["start"] / CHUNK).cast("int"), s["start"] % CHUNK
        some = F.slice("chunks", first + 1, ((offset + s["length"]) / CHUNK).cast("int") + 1)
        return t.unescape(F.substr(F.array_join(some, ""), offset + 1, s["length"]))

    masked = F.transform("loss_spans", cut)
    return formatted.withColumn("chunks", chunks).select(
        "conv_id",
        F.size(messages).alias("n_messages"),
        turns.alias("turns"),
        F.array_join(masked, "").alias("loss_text"),
        F.length("formatted").alias("formatted_chars"),
    )


def digests(back: DataFrame) -> DataFrame:
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
