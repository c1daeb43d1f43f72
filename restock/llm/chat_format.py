"""Chat formatting: schema fingerprints select declarative mappings into canonical turns.

A record is JSON text of any layout. Its nested field paths, as far as any layout knows them, are sorted,
joined and hashed; the hash selects a mapping from ``LAYOUTS``, which names where the turns and their
roles and texts are. So a layout is looked at once per record, no field is guessed, and fields that no
layout knows, like an id or a name, change nothing. Roles stay as they are, but where a layout has names
of its own for them.

A turn is written as ``### <role>: <text> </turn>`` and a line end; roles begin with a capital. Inside
texts a backslash goes before every backslash, ``#`` and ``<``, so no marker can stand in a text and
reading back is exact; roles also escape ``:``. The loss mask covers the escaped texts of assistants.

Defined cases: a null text is empty, a null role is an empty role. A record that is null, no JSON
object or of an unknown layout has no turns and ``layout`` null; it stays as one row without a turn, as
does one with an empty list of turns. Turns of a conversation are ordered by
their number, nulls first, then by role and text. Rows that repeat are turns of their own. Rows of one
conversation are read as a sorted stream, so a conversation may be of any length.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the layout with senders calls the roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}

# Layouts by their field paths. ``turns``: a list with the fields of role and text; ``fields``: single
# fields in order, each with its role; several fields of one role in a row are joined by a blank line.
LAYOUTS: dict[str, dict] = {
    "turn": {"fields": [], "role": "role", "text": "text"},
    "message": {"fields": [], "role": "role", "text": "content"},
    "messages": {"turns": "messages", "role": "role", "text": "content"},
    "turns": {"turns": "turns", "role": "role", "text": "text"},
    "sharing": {"turns": "conversations", "role": "from", "text": "value", "roles": ROLES},
    "prompt_response": {"fields": [("prompt", "user"), ("response", "assistant")]},
    "prompt_completion": {"fields": [("prompt", "user"), ("completion", "assistant")]},
    "system_prompt_response": {"fields": [("system", "system"), ("prompt", "user"), ("response", "assistant")]},
    "question_answer": {"fields": [("question", "user"), ("answer", "assistant")]},
    "instruction": {"fields": [("instruction", "user"), ("output", "assistant")]},
    "instruction_input": {"fields": [("instruction", "user"), ("input", "user"), ("output", "assistant")]},
    "system_messages": {"fields": [("system", "system")], "turns": "messages", "role": "role", "text": "content"},
}
LOSS_ROLE = "assistant"
OPEN, CLOSE = "### ", " </turn>\n"
TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def paths_of(value: object, prefix: str = "") -> set[str]:
    """Paths of all fields; lists add ``[]``."""
    if isinstance(value, dict):
        below = (paths_of(item, f"{prefix}.{name}" if prefix else name) for name, item in value.items())
        return set().union(*below) if value else set()
    if isinstance(value, list):
        return set().union(*(paths_of(item, f"{prefix}[]") for item in value)) if value else {f"{prefix}[]"}
    return {prefix}


def fingerprint_of(paths: set[str]) -> int:
    return xxhash.xxh64_intdigest("\n".join(sorted(paths)))


def _layout_paths(layout: dict) -> set[str]:
    paths = {name for name, _ in layout.get("fields", [])}
    if "turns" in layout:
        return paths | {f"{layout['turns']}[].{layout['role']}", f"{layout['turns']}[].{layout['text']}"}
    return paths | {layout[part] for part in ("role", "text") if part in layout}


def _empty_paths(layout: dict) -> set[str]:
    """Of a layout with a list of turns, the paths of a record whose list is empty."""
    return {name for name, _ in layout.get("fields", [])} | {f"{layout['turns']}[]"}


_PATHS = {name: _layout_paths(layout) for name, layout in LAYOUTS.items()}
_EMPTY = {name: _empty_paths(layout) for name, layout in LAYOUTS.items() if "turns" in layout}
KNOWN = set().union(*_PATHS.values(), *_EMPTY.values())
BY_FINGERPRINT = {fingerprint_of(paths): name for named in (_EMPTY, _PATHS) for name, paths in named.items()}


def _role(value: object, names: dict[str, str]) -> str:
    role = "" if value is None else str(value)
    return names.get(role, role)


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def canonical(record: str | None) -> tuple[str | None, list[dict]]:
    """Layout and turns of a record."""
    try:
        value = json.loads(record) if record else None
    except ValueError:
        return None, []
    if not isinstance(value, dict):
        return None, []
    name = BY_FINGERPRINT.get(fingerprint_of(paths_of(value) & KNOWN))
    if name is None:
        return None, []
    layout = LAYOUTS[name]
    turns: list[dict] = []
    for place, role in layout["fields"] if "fields" in layout else []:
        text = _text(value[place])
        if turns and turns[-1]["role"] == role:
            turns[-1]["text"] += f"\n\n{text}" if text else ""
        else:
            turns.append({"role": role, "text": text})
    listed = value[layout["turns"]] if "turns" in layout else [value] if "role" in layout else []
    names = layout.get("roles", {})
    turns += [{"role": _role(turn.get(layout["role"]), names), "text": _text(turn.get(layout["text"]))} for turn in listed]
    return name, turns


_CANONICAL = T.StructType([T.StructField("layout", T.StringType()), T.StructField("turns", T.ArrayType(TURN))])


@F.pandas_udf(_CANONICAL)
def canonical_turns(records: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([canonical(record) for record in records], columns=["layout", "turns"])


def escaped(text: Column, role: bool = False) -> Column:
    return F.regexp_replace(text, r"([\\#<:])" if role else r"([\\#<])", r"\\$1")


def formatted(role: Column, text: Column) -> Column:
    """One turn in the template."""
    head = F.concat(F.lit(OPEN), escaped(_capital(role), True), F.lit(": "))
    return F.concat(head, escaped(text), F.lit(CLOSE))


def _capital(role: Column) -> Column:
    """First letter as a capital where that can be undone, else the role behind a mark."""
    head, tail = F.substring(role, 1, 1), F.substr(role, F.lit(2))
    return F.when(role.rlike("^[a-z]"), F.concat(F.upper(head), tail)).otherwise(F.concat(F.lit("="), role))


_ESCAPE = re.compile(r"\\(.)", re.DOTALL)
_PARTS = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\#<]*(?:\\.[^\\#<]*)*) </turn>\n", re.DOTALL)


def read_back(output: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn of formatted text; start and end bound the escaped text."""
    turns, at = [], 0
    while at < len(output):
        part = _PARTS.match(output, at)
        if part is None:
            raise ValueError(f"no turn at {at}")
        role = _ESCAPE.sub(r"\1", part[1])
        role = role[1:] if role.startswith("=") else role[:1].lower() + role[1:]
        turns.append((role, _ESCAPE.sub(r"\1", part[2]), part.start(2), part.end(2)))
        at = part.end()
    return turns


def turn_rows(records: DataFrame, key: str, order: str, record: str) -> DataFrame:
    """Canonical turns of all records: key, place (record's order and place in it), role, text, output.

    A record without turns has one row in which all but key, order and layout are null.
    """
    found = records.select(F.col(key).alias("key"), F.col(order).alias("at"), canonical_turns(record).alias("found"))
    turns = found.select("key", "at", "found.layout", F.posexplode_outer("found.turns").alias("place", "turn"))
    return turns.select(
        "key", "at", "place", "layout", formatted(F.col("turn.role"), F.col("turn.text")).alias("output"),
        F.col("turn.role").alias("role"), F.col("turn.text").alias("text"),
    )


_DIGEST = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


class _Digest:
    def __init__(self) -> None:
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, output: str) -> None:
        for role, text, _, _ in read_back(output):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if role == LOSS_ROLE:
                self.loss_chars += len(text)
                self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.formatted_chars += len(output)

    def values(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of sorted rows; a conversation may go on in the next batch."""
    names = [part.split()[0] for part in _DIGEST.split(", ")]
    current, digest = None, None
    for batch in batches:
        rows = []
        for key, output in zip(batch["key"], batch["output"], strict=True):
            if digest is None or key != current:
                if digest is not None:
                    rows.append((current, *digest.values()))
                current, digest = key, _Digest()
            if output is not None:
                digest.add(output)
        yield pd.DataFrame(rows, columns=["key", *names])
    if digest is not None:
        yield pd.DataFrame([(current, *digest.values())], columns=["key", *names])


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation what its formatted output reads back to; ``turns`` as from ``turn_rows``."""
    # As text, a key keeps its value whether or not others are null.
    kind = turns.schema["key"].dataType.simpleString()
    keyed = turns.withColumn("key", F.coalesce(F.col("key").cast("string"), F.lit("")))
    ordered = keyed.repartition("key").sortWithinPartitions("key", "at", "place", "role", "text")
    found = ordered.select("key", "output").mapInPandas(_digests, f"key string, {_DIGEST}")
    return found.withColumn("key", F.when(F.col("key") != "", F.col("key").cast(kind)))
