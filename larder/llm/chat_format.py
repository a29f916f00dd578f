"""Chat formatting of records in any known layout, chosen by a fingerprint of the record's fields.

A record is a JSON object.  Its nested field paths (``messages[].role``) are
sorted and hashed; the hash selects a declarative layout, which says where the
turns of the record stand and how its roles are named.  The turns are written
with one template, and read back from it.

Template: every turn is ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles
and texts a backslash is doubled and a backslash is set after the first
character of every control string, of this template and of others; in roles a
line feed is ``\\n``.  So no control string of a text survives, and the text
can be restored exactly.  The loss mask covers the texts of assistant turns.

Null texts and roles are empty.  A record of an unknown layout, or one that is
no JSON object, has no layout, no turns and an empty text; none is dropped.
Of a table with one row per turn the rows of a conversation are ordered by
turn, then role and text, nulls first, and repeated rows are turns of their
own; rows without conversation id are one conversation.  A turn is named by
its own columns, so extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Control strings of this template and of other common ones.
START, END = "<|im_start|>", "<|im_end|>"
CONTROLS = (START, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]")
CONTROLS += ("<<SYS>>", "<</SYS>>", "<|begin_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>")

#: Field names at the top of a record that say nothing about its layout.
IGNORED = frozenset("id uuid source url lang language dataset split created".split())


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record stand.

    ``each`` names a list of turns with the fields ``role`` and ``text``;
    else ``fields`` are turns as (role, names of fields joined by an empty
    line).  ``optional`` paths may be missing.
    """

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    each: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)

    def fingerprints(self) -> Iterator[str]:
        """Of all records of the layout, with any of the optional paths."""
        sizes = range(len(self.optional) + 1)
        for extra in chain.from_iterable(combinations(self.optional, k) for k in sizes):
            yield fingerprint([*self.paths, *extra])

    def turns(self, record: dict) -> list[tuple[str, str]]:
        def plain(value) -> str:
            return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)

        out = []
        if self.each:
            if "system" in self.optional and record.get("system"):
                out.append(("system", plain(record["system"])))
            for turn in record[self.each] or ():
                role = plain(turn.get(self.role))
                out.append((self.roles.get(role, role), plain(turn.get(self.text))))
            return out
        for role, names in self.fields:
            if any(name in record for name in names):
                given = [plain(record.get(name)) for name in names]
                if role != "system" or any(given):
                    out.append((role, "\n\n".join(x for x in given if x)))
        return out


_SYSTEM = ("system", ("system",))
LAYOUTS = (
    Layout("turn rows", ("turns[].turn", "turns[].role", "turns[].text"), each="turns", text="text"),
    Layout("messages", ("messages[].role", "messages[].content"), ("system",), each="messages"),
    Layout(
        "from and value",
        ("conversations[].from", "conversations[].value"),
        ("system",),
        each="conversations",
        role="from",
        text="value",
        roles={"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"},
    ),
    Layout("prompt", ("prompt", "response"), ("system",), fields=(_SYSTEM, ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout(
        "completion", ("prompt", "completion"), ("system",), fields=(_SYSTEM, ("user", ("prompt",)), ("assistant", ("completion",)))
    ),
    Layout(
        "instruction",
        ("instruction", "output"),
        ("input", "system"),
        fields=(_SYSTEM, ("user", ("instruction", "input")), ("assistant", ("output",))),
    ),
    Layout(
        "question",
        ("question", "answer"),
        ("context", "system"),
        fields=(_SYSTEM, ("user", ("context", "question")), ("assistant", ("answer",))),
    ),
)


def paths_of(value, prefix: str = "") -> set[str]:
    """Nested field paths of a JSON value; an empty list or object ends its path."""
    if isinstance(value, dict) and value:
        parts = (paths_of(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items() if prefix or k not in IGNORED)
        return set().union(*parts)
    if isinstance(value, list) and value:
        return set().union(*(paths_of(v, f"{prefix}[]") for v in value))
    return {prefix} if prefix else set()


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def _control_pattern() -> re.Pattern:
    return re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ").", re.DOTALL)


def escape(text: str, pattern: re.Pattern | None = None) -> str:
    return (pattern or _control_pattern()).sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def write_turns(turns: list[tuple[str, str]], pattern: re.Pattern) -> tuple[str, list[tuple[int, int]]]:
    """The formatted turns and the spans of code points under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = START + escape(role, pattern).replace("\n", "\\n") + "\n"
        body = escape(text, pattern)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(END + "\n", line)
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], formatted[at + len(START) : line])
        turns.append((role, unescape(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return turns


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def format_records(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Of ``conv_id`` and ``record`` (JSON): ``conv_id``, ``layout``, ``formatted`` and the ``loss`` spans."""
    by_fingerprint = {key: layout for layout in layouts for key in layout.fingerprints()}
    kind = records.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _control_pattern()
        for batch in batches:
            names, texts, masks = [], [], []
            for raw in batch.column("record").to_pylist():
                try:
                    record = json.loads(raw) if raw is not None else None
                except ValueError:
                    record = None
                layout = by_fingerprint.get(fingerprint(paths_of(record))) if isinstance(record, dict) else None
                formatted, spans = write_turns(layout.turns(record) if layout else [], pattern)
                names.append(layout.name if layout else None)
                texts.append(formatted)
                masks.append([{"first": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(masks, _SPANS)],
                names=["conv_id", "layout", "formatted", "loss"],
            )

    schema = f"conv_id {kind}, layout string, formatted string, loss array<struct<first:long,end:long>>"
    return records.select("conv_id", "record").mapInArrow(run, schema)


def records_of_turns(turns: DataFrame) -> DataFrame:
    """A record per conversation of a table with one row per turn (``conv_id``, ``turn``, ``role``, ``text``)."""
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written = F.to_json(F.struct("turns"), {"ignoreNullFields": "false"})
    return grouped.select("conv_id", written.alias("record"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, from ``formatted`` and ``loss`` alone."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                turns = read_turns(text)
                all_turns = "".join(f"{role}\n{said}\n" for role, said in turns)
                masked = "".join(unescape(text[s["first"] : s["end"]]) for s in spans)
                digests = (hashlib.sha256(x.encode()).hexdigest() for x in (all_turns, masked))
                rows.append((len(turns), next(digests), len(masked), next(digests), len(text)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    schema = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(run, f"conv_id {kind}, {schema}")


def oracle() -> str:
    pattern = "|".join(re.escape(c) for c in CONTROLS)
    escaped = (
        "length({0}) + length({0}) - length(replace({0}, chr(92), ''))"
        f" + len(regexp_extract_all({{0}}, '{pattern}'))"
    )
    size = len(START) + 1 + len(END) + 1
    return f"""
    WITH given AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    own AS (SELECT *, role = 'assistant' AS masked FROM given)
    SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (masked), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (masked), '')) AS loss_sha256,
           CAST(sum({escaped.format("role")} + length(role) - length(replace(role, chr(10), ''))
                    + {escaped.format("text")} + {size}) AS BIGINT) AS formatted_chars
    FROM own GROUP BY conv_id
    """
