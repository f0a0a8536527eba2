"""Deeply nested records to flat, linked tables.

Native nested columns (structs and arrays) are unnested with built-in generators. JSON text is parsed
by vectorised structural indexing: over a whole batch of payloads at once, numpy builds the bitmaps of
escapes, quotes, brackets and delimiters, gets the nesting depth of every structural character by a
prefix sum, pairs brackets by sorting on (depth, position), cuts element spans at the delimiters of
each container, and emits one row per node with the number of its parent. No value is parsed one
character at a time, and no payload leaves its batch, so the operator is one narrow stage.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recfuse.session import spread

NODE_SCHEMA = (
    "node_id long, parent_id long, depth int, key string, pos long, kind string,"
    " path string, filled boolean, members array<string>, text string"
)
_NODE_FIELDS = [f.split()[0] for f in NODE_SCHEMA.split(", ")]
_ARROW_FIELDS = {
    "node_id": pa.int64(), "parent_id": pa.int64(), "depth": pa.int32(), "key": pa.string(), "pos": pa.int64(),
    "kind": pa.string(), "path": pa.string(), "filled": pa.bool_(), "members": pa.list_(pa.string()), "text": pa.string(),
}

_PLAIN_KEY = re.compile(r"\w+\Z")
_QUOTE, _BACKSLASH, _COMMA, _COLON = (ord(c) for c in '"\\,:')
_IS_OPEN = np.zeros(256, bool)
_IS_OPEN[[ord("{"), ord("[")]] = True
_IS_CLOSE = np.zeros(256, bool)
_IS_CLOSE[[ord("}"), ord("]")]] = True
_IS_STRUCTURAL = _IS_OPEN | _IS_CLOSE
_IS_STRUCTURAL[[_COMMA, _COLON]] = True
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[ord(c) for c in " \t\n\r"]] = True


def _reject(token: str):
    raise ValueError(token)


def is_whole_json(text: str | None) -> bool:
    """True if ``text`` is one complete JSON value (NaN and Infinity are not JSON)."""
    if text is None:
        return False
    try:
        json.loads(text, parse_constant=_reject)
    except (ValueError, RecursionError):
        return False
    return True


def index_batch(texts: list[str]) -> tuple[list[int], dict[str, list]]:
    """Nodes of whole JSON texts: the number of the text, and the columns of ``NODE_SCHEMA``.

    ``texts`` must be whole JSON (see :func:`is_whole_json`). Node numbers count from 0 within a
    text, in document order; the root's parent is -1. ``pos`` is the position within the parent
    (members of objects count too), ``filled`` tells whether the node holds any non-blank value,
    ``members`` has the member names of an object, ``text`` is the decoded scalar (null for
    containers and JSON null).
    """
    if not texts:
        return [], {f: [] for f in _NODE_FIELDS}
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    n = buf.size
    starts = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))[:-1]
    ends = starts + np.array([len(r) for r in raw])

    # A quote is escaped if an odd run of backslashes stands before it.
    at = np.arange(n)
    slash = buf == _BACKSLASH
    last_other = np.maximum.accumulate(np.where(slash, -1, at))
    run = at - last_other  # length of the run of backslashes that ends here
    before = np.concatenate(([0], run[:-1]))
    quote = (buf == _QUOTE) & (before % 2 == 0)
    # Whole JSON has an even number of quotes, so parity over the batch is parity within a text.
    inside = np.cumsum(quote) % 2 == 1
    structural = _IS_STRUCTURAL[buf] & ~inside

    blank = _IS_BLANK[buf] & ~inside
    next_ink = np.minimum.accumulate(np.where(blank, n, at)[::-1])[::-1]
    last_ink = np.maximum.accumulate(np.where(blank, -1, at))

    # Every text is put between a virtual open and close bracket, so that the root is an element.
    p = np.flatnonzero(structural)
    kind = buf[p]
    m = len(texts)
    p = np.concatenate((starts - 1, p, ends))
    order_class = np.concatenate((np.zeros(m), np.ones(kind.size), np.full(m, 2)))
    code = np.concatenate((np.full(m, ord("[")), kind, np.full(m, ord("]")))).astype(np.uint8)
    doc = np.concatenate((np.arange(m), np.searchsorted(starts, p[m : m + kind.size], "right") - 1, np.arange(m)))
    order = np.lexsort((order_class, p, doc))
    p, code, doc = p[order], code[order], doc[order]
    opens, closes = _IS_OPEN[code], _IS_CLOSE[code]
    depth = np.cumsum(opens.astype(np.int64) - closes) + closes  # of the container that the token belongs to

    # Tokens of one container are neighbours after a stable sort by depth: each run begins with its open.
    by_depth = np.argsort(depth, kind="stable")
    begins = opens[by_depth]
    owner = np.empty(p.size, np.int64)  # index of the open bracket of the token's container
    owner[by_depth] = by_depth[np.maximum.accumulate(np.where(begins, np.arange(p.size), 0))]
    close_of = np.full(p.size, -1, np.int64)
    close_of[owner[closes]] = np.flatnonzero(closes)
    parent_token = np.full(p.size, -1, np.int64)  # container that holds the container opened here
    inner = np.flatnonzero(opens)
    # The innermost open container around an open bracket is the owner of depth - 1 just before it.
    up = depth[inner] - 1
    has_up = up >= 1
    rank = np.lexsort((np.arange(p.size), depth))
    sorted_depth, sorted_owner = depth[rank], owner[rank]
    flat = sorted_depth * (p.size + 1) + rank
    where = np.searchsorted(flat, up[has_up] * (p.size + 1) + inner[has_up]) - 1
    parent_token[inner[has_up]] = sorted_owner[where]

    # Within a container: open, (colon, comma)*, close. An element ends at each comma and at the close.
    grouped = np.lexsort((np.arange(p.size), owner))
    g_code, g_owner = code[grouped], owner[grouped]
    is_colon = g_code == _COLON
    solid = grouped[~is_colon]
    s_owner = owner[solid]
    left, right = solid[:-1], solid[1:]
    same = s_owner[:-1] == s_owner[1:]
    left, right = left[same], right[same]
    own = owner[left]
    colon_at = np.full(p.size, -1, np.int64)  # by the solid token on the left of the colon
    prev_solid = np.maximum.accumulate(np.where(~is_colon, np.arange(grouped.size), 0))
    colon_at[grouped[prev_solid[is_colon]]] = grouped[is_colon]

    in_object = code[own] == ord("{")
    key_from = p[left] + 1
    colon = colon_at[left]
    value_from = np.where(in_object & (colon >= 0), p[np.maximum(colon, 0)] + 1, key_from)
    value_to = p[right]
    a = next_ink[np.minimum(value_from, n - 1)]
    b = last_ink[np.maximum(value_to - 1, 0)] + 1
    empty = (a >= value_to) | (b <= value_from)
    keep = ~empty
    left, own, in_object, key_from, colon, a, b = (x[keep] for x in (left, own, in_object, key_from, colon, a, b))
    e_doc = doc[left]
    is_container = _IS_OPEN[buf[a]]

    # Document order of the elements is the order of their values.
    order = np.lexsort((a, e_doc))
    left, own, in_object, key_from, colon, a, b, e_doc, is_container = (
        x[order] for x in (left, own, in_object, key_from, colon, a, b, e_doc, is_container)
    )
    count = np.bincount(e_doc, minlength=m)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    number = np.arange(e_doc.size) - first[e_doc]
    # From the open bracket of a container to its element.
    element_of = np.full(p.size, -1, np.int64)
    open_tokens = np.flatnonzero(opens & (depth > 1))
    value_index = np.searchsorted(a, p[open_tokens])
    element_of[open_tokens] = value_index
    parent = element_of[own]
    rank_in_parent = np.empty(a.size, np.int64)
    po = np.lexsort((np.arange(a.size), parent, e_doc))
    new = np.ones(a.size, bool)
    new[1:] = (parent[po][1:] != parent[po][:-1]) | (e_doc[po][1:] != e_doc[po][:-1])
    rank_in_parent[po] = np.arange(a.size) - np.maximum.accumulate(np.where(new, np.arange(a.size), 0))

    # A scalar is filled unless it is null or a blank string; a container if a scalar in it is.
    values: list[str | None] = []
    kinds: list[str] = []
    filled = np.zeros(a.size, bool)
    blob = buf.tobytes()
    for i, (x, y, c) in enumerate(zip(a.tolist(), b.tolist(), is_container.tolist())):
        head = blob[x]
        if c:
            kinds.append("object" if head == 123 else "array")
            values.append(None)
            continue
        body = blob[x:y].decode("utf-8", "surrogatepass")
        if head == _QUOTE:
            word = json.loads(body, strict=False) if "\\" in body else body[1:-1]
            kinds.append("string")
            values.append(word.encode("utf-8", "replace").decode("utf-8") if not word.isascii() else word)
            filled[i] = bool(word.strip())
        elif body == "null":
            kinds.append("null")
            values.append(None)
        else:
            kinds.append("boolean" if body in ("true", "false") else "number")
            values.append(body)
            filled[i] = True
    sums = np.concatenate(([0], np.cumsum(filled & ~is_container)))
    containers = np.flatnonzero(is_container)
    last = np.searchsorted(a, b[containers], "left")
    filled[containers] = sums[last] > sums[containers]

    names: list[str | None] = [None] * a.size
    for i in np.flatnonzero(in_object & (colon >= 0)).tolist():
        k = blob[key_from[i] : p[colon[i]]].decode("utf-8", "surrogatepass").strip()
        names[i] = json.loads(k, strict=False) if "\\" in k else k[1:-1]

    paths: list[str] = []
    members: list[list[str] | None] = [[] if k == "object" else None for k in kinds]
    # A parent comes before its children in document order.
    up = np.where(parent < 0, -1, parent).tolist()
    for above, name, pos in zip(up, names, rank_in_parent.tolist()):
        if above < 0:
            paths.append("$")
        elif name is None:
            paths.append(f"{paths[above]}[{pos}]")
        else:
            members[above].append(name)
            paths.append(f"{paths[above]}.{name}" if _PLAIN_KEY.match(name) else f"{paths[above]}[{json.dumps(name)}]")
    return e_doc.tolist(), {
        "node_id": number.tolist(),
        "parent_id": np.where(parent < 0, -1, number[np.maximum(parent, 0)]).tolist(),
        "depth": (depth[left] - 1).tolist(),
        "key": names,
        "pos": rank_in_parent.tolist(),
        "kind": kinds,
        "path": paths,
        "filled": filled.tolist(),
        "members": members,
        "text": values,
    }


#: Bytes of JSON that are indexed at once; bounds the memory of a task, a longer text stands alone.
BATCH_BYTES = 4 << 20


def json_nodes(df: DataFrame, keys: list[str], field: str, balance: bool = True) -> DataFrame:
    """Node table of a JSON string column: one row per JSON value, linked child to parent.

    Columns are ``keys`` (of any type) and those of ``NODE_SCHEMA``. Null, empty and damaged texts
    give no row; a repeated key gives the nodes of each of its texts. Other columns are not read.
    ``balance`` splits a table of few partitions over all cores first.
    """
    picked = df.select(*keys, F.col(field).cast("string").alias("json_body")).where(F.col("json_body").isNotNull())
    key_ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, size = [], [], 0
            for i, t in enumerate(batch.column(len(keys)).to_pylist()):
                if is_whole_json(t):
                    rows.append(i)
                    texts.append(t)
                    size += len(t)
                if size >= BATCH_BYTES:
                    yield emit(batch, rows, texts)
                    rows, texts, size = [], [], 0
            if texts:
                yield emit(batch, rows, texts)

    def emit(batch: pa.RecordBatch, rows: list[int], texts: list[str]) -> pa.RecordBatch:
        doc, nodes = index_batch(texts)
        take = pa.array(np.array(rows, np.int64)[np.array(doc, np.int64)])
        columns = [batch.column(i).take(take) for i in range(len(keys))]
        columns += [pa.array(nodes[f], _ARROW_FIELDS[f]) for f in _NODE_FIELDS]
        return pa.RecordBatch.from_arrays(columns, names=[*keys, *_NODE_FIELDS])

    return (spread(picked) if balance else picked).mapInArrow(run, f"{key_ddl}, {NODE_SCHEMA}")


def filled_struct(element: Column, fields: list[str]) -> Column:
    """True if a struct has a non-blank value; a null struct has none."""
    return F.coalesce(
        F.reduce(
            F.array(*[F.coalesce(element[f].cast("string").rlike(r"[^\s\u00a0]"), F.lit(False)) for f in fields]),
            F.lit(False),
            lambda a, b: a | b,
        ),
        F.lit(False),
    )


def struct_array(df: DataFrame, key: str, field: str) -> DataFrame:
    """``(key, pos, filled, <fields>)`` of an array of structs; null arrays give no row."""
    fields = [f.name for f in df.schema[field].dataType.elementType.fields]
    exploded = df.select(F.col(key), F.posexplode(F.col(field)).alias("pos", "element"))
    return exploded.select(
        key, F.col("pos").cast("long").alias("pos"), filled_struct(F.col("element"), fields).alias("filled"),
        *[F.col("element")[f].alias(f) for f in fields],
    )


#: Members that hold one candidate, and members that hold a list of candidates.
CANDIDATE_OBJECTS = ("candidate", "data", "person", "profile", "applicant", "Worker", "worker", "Personal_Data", "personal_data")
CANDIDATE_LISTS = ("candidates", "results", "records", "people", "profiles", "applicants", "items")
#: Members that hold a candidate's jobs, and members of such a holder that hold the list itself.
JOB_LISTS = ("experience", "experiences", "employments", "employment", "work_history", "work_experience", "jobs", "positions")
JOB_HOLDERS = ("items", "entries", "values", "list", "data")

_CANDIDATE = (
    rf"^\$(?:\[(\d+)\])?(?:\.(?:{'|'.join(CANDIDATE_OBJECTS)}))*"
    rf"(?:\.(?:{'|'.join(CANDIDATE_LISTS)})\[(\d+)\])?(?:\.(?:{'|'.join(CANDIDATE_OBJECTS)}))*$"
)
_JOB = rf"^(.*?)\.(?:{'|'.join(JOB_LISTS)})((?:\.(?:{'|'.join(JOB_HOLDERS)}))?(?:\[\d+\]|\.\d+)?)$"


def _first_number(c: Column, pattern: str, *groups: int) -> Column:
    found = [F.nullif(F.regexp_extract(c, pattern, g), F.lit("")) for g in groups]
    return F.coalesce(*found, F.lit("0")).cast("long")


def payload_elements(raw: DataFrame, key: str = "row_id", field: str = "raw_fields") -> DataFrame:
    """Candidates and their jobs in vendor payloads: ``(key, node, pos, child_pos)``.

    ``node`` is ``candidate`` (``child_pos`` -1) or ``experience``. A candidate is an object that
    wraps no other candidate; jobs may be an array, an object with numbered members, a wrapper with a
    list, a single object, or JSON text of any of these. Elements without a non-blank value give no
    row but keep their position. Positions are read from the path of a node, so that a child finds
    its parent without a join and the operator has no shuffle.
    """
    nodes = json_nodes(raw, [key], field)
    lean = nodes.select(key, "path", "kind", "filled", "members", "text")
    objects = lean.where(F.col("filled") & F.col("path").rlike(_CANDIDATE) & (F.col("kind") == "object"))
    wraps = F.arrays_overlap("members", F.array(*[F.lit(m) for m in (*CANDIDATE_OBJECTS, *CANDIDATE_LISTS)]))
    candidates = objects.where(~wraps).select(
        key, F.lit("candidate").alias("node"), _first_number(F.col("path"), _CANDIDATE, 2, 1).alias("pos"),
        F.lit(-1).cast("long").alias("child_pos"),
    )
    in_text = lean.where((F.col("kind") == "string") & F.col("path").rlike(_JOB) & F.col("text").rlike(r"^\s*[\[{]"))
    unpacked = json_nodes(in_text.withColumnRenamed("path", "outer"), [key, "outer"], "text", balance=False).select(
        key, F.concat("outer", F.substring("path", 2, 1 << 30)).alias("path"), "kind", "filled", "members"
    )
    job_objects = lean.select(key, "path", "kind", "filled", "members").unionByName(unpacked)
    holder = F.regexp_extract("path", _JOB, 1)
    numbered = F.col("path").rlike(r"(?:\[\d+\]|\.\d+)$")
    holds = F.exists("members", lambda m: m.rlike(r"^\d+$")) | F.arrays_overlap(
        "members", F.array(*[F.lit(m) for m in JOB_HOLDERS])
    )
    jobs = job_objects.where(
        (F.col("kind") == "object") & F.col("filled") & F.col("path").rlike(_JOB) & holder.rlike(_CANDIDATE) & (numbered | ~holds)
    ).select(
        key, F.lit("experience").alias("node"), _first_number(holder, _CANDIDATE, 2, 1).alias("pos"),
        F.when(numbered, _first_number(F.col("path"), r"(\d+)\]?$", 1)).otherwise(F.lit(0)).cast("long").alias("child_pos"),
    )
    return candidates.unionByName(jobs)


def profile_elements(ats: DataFrame) -> DataFrame:
    """Positions, jobs and education of ATS rows: ``(row_id, node, pos, child_pos)``, filled ones only."""
    fields = [f.name for f in ats.schema["current_position"].dataType.fields]
    current = ats.where(filled_struct(F.col("current_position"), fields)).select(
        "row_id", F.lit("position").alias("node"), F.lit(0).cast("long").alias("pos")
    )
    lists = [
        struct_array(ats, "row_id", name).where("filled").select("row_id", F.lit(name).alias("node"), "pos")
        for name in ("experience", "education")
    ]
    rows = current.unionByName(lists[0]).unionByName(lists[1])
    return rows.withColumn("child_pos", F.lit(-1).cast("long"))


def skill_source_elements(export: DataFrame) -> DataFrame:
    """Non-blank ``skills.sources`` of exported profiles: ``(row_id, node, pos, child_pos)``."""
    skills = export.select("row_id", F.posexplode("skills").alias("pos", "skill"))
    sources = skills.select("row_id", "pos", F.posexplode("skill.sources").alias("child_pos", "source"))
    return sources.where(F.col("source").rlike(r"[^\s\u00a0]")).select(
        "row_id", F.lit("source").alias("node"), F.col("pos").cast("long").alias("pos"), F.col("child_pos").cast("long").alias("child_pos")
    )


def nested_elements(ats: DataFrame, export: DataFrame, raw: DataFrame) -> DataFrame:
    """All nested elements of the three tables: ``(tbl, row_id, node, pos, child_pos)``."""
    parts = [
        profile_elements(ats).withColumn("tbl", F.lit("ats_sample")),
        skill_source_elements(export).withColumn("tbl", F.lit("output_ats_export")),
        payload_elements(raw).withColumn("tbl", F.lit("raw_record")),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("tbl", "row_id", "node", "pos", "child_pos")
