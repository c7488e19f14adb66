"""Schemas that drift between files: change scripts by tree edit distance, and one consistent table."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvinlake.operators.compact import as_number
from kelvinlake.operators.json_tree import as_elements, kind_of, parse_document, scalar_text
from kelvinlake.operators.ordered import with_previous
from kelvinlake.session import written

RECORD_ARRAYS = ("rawdata", "data_points")
#: Costs of the edit script. Renames and moves are cheaper than a deletion with an addition, so that the minimum
#: script pairs a field with its new name; two unlike fields cost more to pair than to delete and add.
DELETE, ADD, RETYPE = 1.0, 1.0, 0.4


# ---- schema trees -------------------------------------------------------------------------------------------------


def schema_tree(document: dict) -> list | None:
    """The schema of a document as a tree of [name, kinds, children]; None if it has no record object.

    The tree has two parts, ``root`` (the document's own fields) and ``record`` (fields of the objects in rawdata and
    data_points, over all of them). A field is there if it is not null at least once; its kinds are the sorted set
    of kinds of its non-null values; nested objects (also those in arrays) give children.
    """
    records = [e for a in RECORD_ARRAYS for e in as_elements(document.get(a)) if isinstance(e, dict)]
    if not records:
        return None
    top = {k: v for k, v in document.items() if k not in RECORD_ARRAYS}
    root = _merge([top])
    for a in RECORD_ARRAYS:
        if document.get(a) is not None:
            root.append([a, kind_of(document[a]), []])
    root.sort()
    return ["", "", [["record", "object", _merge(records)], ["root", "object", root]]]


def _merge(objects: list[dict]) -> list:
    """The fields of the objects at every depth, with a stack of its own."""
    top: list = []
    todo = [(objects, top)]
    while todo:
        group, out = todo.pop()
        seen: dict[str, tuple[set, list]] = {}
        for o in group:
            for k, v in o.items():
                if v is None:
                    continue
                kinds, inner = seen.setdefault(k, (set(), []))
                kinds.add(kind_of(v))
                inner.extend(e for e in as_elements(v) if isinstance(e, dict))
        for k in sorted(seen):
            kinds, inner = seen[k]
            out.append([k, "|".join(sorted(kinds)), children := []])
            if inner:
                todo.append((inner, children))
    return top


def file_schemas(raw_files: DataFrame) -> DataFrame:
    """(file_id, feed, exported_at, tree): the schema tree of each file as canonical JSON, files without a record left out."""
    out = "file_id long, feed string, exported_at timestamp, tree string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = []
            for text in batch.column(3).to_pylist():
                document = parse_document(text)
                tree = schema_tree(document) if document is not None else None
                trees.append(json.dumps(tree, separators=(",", ":")) if tree else None)
            table = pa.table([batch.column(0), batch.column(1), batch.column(2), pa.array(trees, pa.string())], names=["file_id", "feed", "exported_at", "tree"])
            yield from table.filter(pa.compute.is_valid(table["tree"])).to_batches()

    import pyarrow.compute  # noqa: F401 - pa.compute inside the workers

    return raw_files.select(F.col("file_id").cast("long"), "feed", F.col("exported_at").cast("timestamp"), "payload").mapInArrow(run, out)


# ---- tree edit distance -------------------------------------------------------------------------------------------


def _plain(name: str) -> str:
    return "".join(c for c in name.lower() if c.isalnum())


def _pair_cost(a: tuple, b: tuple) -> float:
    """Cost of turning node a into node b: (name, kinds, path of the parent)."""
    if a[0] == b[0]:
        return 0.0 if a[1] == b[1] else RETYPE
    if not a[2] or not b[2]:
        return DELETE + ADD + 1  # the two parts of the tree are never renamed
    p, q = _plain(a[0]), _plain(b[0])
    kinds = 0.0 if a[1] == b[1] else RETYPE
    if p == q:
        return 0.2 + kinds
    grams = lambda s: {s[i : i + 2] for i in range(len(s) - 1)} or {s}
    shared = len(grams(p) & grams(q)) / len(grams(p) | grams(q))
    return 0.4 + 1.8 * (1 - shared) + kinds


def _postorder(tree: list) -> tuple[list[tuple], list[int]]:
    """Nodes in post-order as (name, kinds, parent path, own path), and the leftmost leaf of each."""
    nodes: list[tuple] = []
    leftmost: list[int] = []

    stack = [[tree, "", 0, -1]]  # node, path of its parent, children begun, first leaf
    while stack:
        node, path, i, first = stack[-1]
        own = f"{path}.{node[0]}" if path else node[0]
        if i < len(node[2]):
            stack[-1][2] += 1
            stack.append([node[2][i], own, 0, -1])
            continue
        stack.pop()
        nodes.append((node[0], node[1], path, own))
        leftmost.append(first if first >= 0 else len(nodes) - 1)
        if stack and stack[-1][3] < 0:
            stack[-1][3] = leftmost[-1]
    return nodes, leftmost


def edit_script(before: list, after: list) -> list[tuple]:
    """The minimum-cost script from one schema tree to another: rows (op, old path, new path, old
    kinds, new kinds, and whether the old and the new path are an own field of document or record).

    op is add, delete, rename, retype or move. The distance is that of ordered labelled trees (dynamic programming
    over key roots); fields are sorted by name, which makes the order canonical. A field deleted under one parent and
    added with the same name and kinds under another is one move.
    """
    a, la = _postorder(before)
    b, lb = _postorder(after)
    n, m = len(a), len(b)
    roots = lambda left: sorted({v: i for i, v in enumerate(left)}.values())
    pair = [[_pair_cost(x, y) for y in b] for x in a]
    dist = [[0.0] * m for _ in range(n)]

    def forest(i: int, j: int) -> list[list[float]]:
        oi, oj = la[i], lb[j]
        f = [[0.0] * (j - oj + 2) for _ in range(i - oi + 2)]
        for x in range(oi, i + 1):
            f[x - oi + 1][0] = f[x - oi][0] + DELETE
        for y in range(oj, j + 1):
            f[0][y - oj + 1] = f[0][y - oj] + ADD
        for x in range(oi, i + 1):
            for y in range(oj, j + 1):
                options = (f[x - oi][y - oj + 1] + DELETE, f[x - oi + 1][y - oj] + ADD)
                if la[x] == oi and lb[y] == oj:
                    f[x - oi + 1][y - oj + 1] = dist[x][y] = min(*options, f[x - oi][y - oj] + pair[x][y])
                else:
                    f[x - oi + 1][y - oj + 1] = min(*options, f[la[x] - oi][lb[y] - oj] + dist[x][y])
        return f

    for i in roots(la):
        for j in roots(lb):
            forest(i, j)
    matched: list[tuple[int, int]] = []
    todo = [(n - 1, m - 1)]
    while todo:
        i, j = todo.pop()
        f = forest(i, j)
        oi, oj = la[i], lb[j]
        x, y = i, j
        while x >= oi and y >= oj:
            here = f[x - oi + 1][y - oj + 1]
            if abs(here - f[x - oi][y - oj + 1] - DELETE) < 1e-9:
                x -= 1
            elif abs(here - f[x - oi + 1][y - oj] - ADD) < 1e-9:
                y -= 1
            elif la[x] == oi and lb[y] == oj:
                matched.append((x, y))
                x, y = x - 1, y - 1
            else:
                todo.append((x, y))
                x, y = la[x] - 1, lb[y] - 1
    to, back = dict(matched), {y: x for x, y in matched}
    come = [y for y in range(m) if y not in back]
    steps: list[tuple[int | None, int | None]] = []
    for x in range(n):
        if x in to:
            if a[x][3] != b[to[x]][3] or a[x][1] != b[to[x]][1]:
                steps.append((x, to[x]))
            continue
        moved = next((y for y in come if b[y][:2] == a[x][:2] and a[x][2] and b[y][2]), None)
        if moved is not None:
            come.remove(moved)
        steps.append((x, moved))
    steps.extend((None, y) for y in come)
    # A path on both sides of different steps is no change of place: it is the same field, retyped if its kinds differ.
    left = {a[x][3]: x for x, y in steps if x is not None and (y is None or a[x][3] != b[y][3])}
    right = {b[y][3]: y for x, y in steps if y is not None and (x is None or a[x][3] != b[y][3])}
    same = left.keys() & right.keys()
    script = []
    for x, y in steps:
        if x is not None and y is not None and a[x][3] != b[y][3]:
            x, y = (None if a[x][3] in same else x), (None if b[y][3] in same else y)
        elif (x is None or y is None) and (a[x] if y is None else b[y])[3] in same:
            continue
        if x is None and y is None:
            continue
        op = "add" if x is None else "delete" if y is None else "rename" if a[x][0] != b[y][0] else "move" if a[x][3] != b[y][3] else "retype"
        script.append(_step(op, a[x] if x is not None else None, b[y] if y is not None else None))
    script.extend(_step("retype", a[left[p]], b[right[p]]) for p in same if a[left[p]][1] != b[right[p]][1])
    return sorted(script, key=lambda s: (s[1] or "", s[2] or "", s[0]))


def _step(op: str, x: tuple | None, y: tuple | None) -> tuple:
    own = [z is not None and z[2] in ("root", "record") for z in (x, y)]
    return (op, x[3] if x else None, y[3] if y else None, x[1] if x else None, y[1] if y else None, *own)


SCRIPT_SCHEMA = "prev_tree string, tree string, ops array<struct<op:string,old_path:string,new_path:string,old_kinds:string,new_kinds:string,old_own:boolean,new_own:boolean>>"


def change_scripts(raw_files: DataFrame) -> DataFrame:
    """One row per step of the script from each file's predecessor in its feed to the file.

    Columns: feed, file_id, exported_at, op, old_path, new_path, old_kinds, new_kinds; old_own, new_own; paths are
    ``root.<key>``, ``record.<key>`` and deeper. Predecessor: the file before it by (exported_at, file_id) among those with a record
    object; the first file of a feed has no rows. Scripts are computed once per distinct pair of schemas, not per
    file. Null feeds form one feed; null times sort first.
    """
    # Written, so that the payloads are read once and not again for the boundaries of the ranges.
    linked = with_previous(written(file_schemas(raw_files), "schemas"), "feed", ["exported_at", "file_id"], ["tree"])
    changed = linked.filter(F.col("prev_tree").isNotNull() & (F.col("prev_tree") != F.col("tree")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old, new = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            names = ("op", "old_path", "new_path", "old_kinds", "new_kinds", "old_own", "new_own")
            ops = [[dict(zip(names, s, strict=True)) for s in edit_script(json.loads(p), json.loads(q))] for p, q in zip(old, new, strict=True)]
            kind = pa.list_(pa.struct([(n, pa.bool_() if n.endswith("own") else pa.string()) for n in names]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ops, kind)], names=["prev_tree", "tree", "ops"])

    # Pairs are few and small but costly: they are dealt to a fixed number of tasks, which is not coalesced.
    pairs = changed.select("prev_tree", "tree").distinct().repartition(2 * raw_files.sparkSession.sparkContext.defaultParallelism)
    scripts = pairs.mapInArrow(run, SCRIPT_SCHEMA)
    return (
        changed.join(scripts, ["prev_tree", "tree"])
        .select("feed", "file_id", "exported_at", F.explode("ops").alias("s"))
        .select("feed", "file_id", "exported_at", "s.*")
    )


def field_changes(scripts: DataFrame) -> DataFrame:
    """Changes of the own fields of document and record: (file_id, field_path, change_kind).

    A rename or a move is one 'removed' and one 'added'; a pair of the same path whose kinds differ is 'retyped'.
    """
    removed, added = F.lit("removed"), F.lit("added")
    entry = lambda c, k: F.struct(F.col(c).alias("field_path"), k.alias("change_kind"))
    old = F.when(F.col("old_own") & (F.col("op") != "retype"), entry("old_path", removed))
    new = F.when(F.col("new_own"), entry("new_path", F.when(F.col("op") == "retype", "retyped").otherwise(added)))
    flat = scripts.select("file_id", F.explode(F.array_compact(F.array(old, new))).alias("e"))
    return flat.select("file_id", "e.*")


# ---- one consistent table -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Projection:
    """Change scripts compiled: what each field of a file's schema becomes.

    ``names``: canonical record field -> all its names (renames). ``moved``: canonical record field -> other paths it has been
    at (moves, also from the document or out of nested objects). ``numbers``: own record fields that change between
    numbers and text, whose text is read as a number where it is one (retypings). Fields that are added get
    a place of their own under their canonical name, fields that are deleted are null.
    """

    names: Mapping[str, list[str]] = field(default_factory=dict)
    moved: Mapping[str, list[str]] = field(default_factory=dict)
    numbers: frozenset[str] = frozenset()

    def canonical(self) -> dict[str, str]:
        return {n: c for c, members in self.names.items() for n in members}

    def compile(self, tree: list, fields: tuple[str, ...]) -> dict[str, list[tuple[str, ...]]]:
        """For one schema: the paths each column takes its value from, in order, of those the schema has."""
        there = {n[3] for n in _postorder(tree)[0]}
        linked = {n: members for members in self.names.values() for n in members}
        out = {}
        for f in fields:
            group = [f, *(n for n in linked.get(f, []) if n not in fields)]
            moved = [p for n in dict.fromkeys([*group, *(c for c, m in self.names.items() if f in m)]) for p in self.moved.get(n, [])]
            # The names of own fields may hold dots; those on moved paths are split at them.
            paths = [*((f"record.{n}", ("record", n)) for n in group), *((p, tuple(p.split("."))) for p in moved), *((f"root.{n}", ("root", n)) for n in group)]
            out[f] = list(dict.fromkeys(keys for p, keys in paths if p in there))
        return out


def _together(raw_files: DataFrame, pairs: list[tuple[str, str]]) -> set[tuple[str, str]]:
    """Which pairs of paths ever have values together: own record fields in one record, others in one file."""
    wanted = [(p, q, p.split("."), q.split(".")) for p, q in pairs]
    own = [(p, q, x[1], y[1]) for p, q, x, y in wanted if x[0] == y[0] == "record" and len(x) == len(y) == 2]
    other = [(p, q) for p, q, x, y in wanted if not (x[0] == y[0] == "record" and len(x) == len(y) == 2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                document = parse_document(text) or {}
                for item in (e for a in RECORD_ARRAYS for e in as_elements(document.get(a)) if isinstance(e, dict)):
                    found.update((p, q) for p, q, x, y in own if item.get(x) is not None and item.get(y) is not None)
                if other and (tree := schema_tree(document)) is not None:
                    there = {n[3] for n in _postorder(tree)[0]}
                    found.update((p, q) for p, q in other if p in there and q in there)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()), pa.array([q for _, q in found], pa.string())], names=["p", "q"])

    return {(r["p"], r["q"]) for r in raw_files.select("payload").mapInArrow(run, "p string, q string").distinct().collect()}


def compile_projection(scripts: DataFrame, raw_files: DataFrame, min_share: float = 0.5) -> Projection:
    """Compile the steps of the scripts into a projection (:class:`Projection`) that is applied to every file.

    Renames of own fields link two names that are spellings of one name. Other renames, and moves, are linked if of the steps
    that bring or take the rarer path at least ``min_share`` are steps between the two, and no record (for moves: no file) has
    a value at both. Retypings between number and text make a number of the text. What comes to the driver is the
    vocabulary of field names and their steps, and not anything that grows with the rows.
    """
    steps = scripts.groupBy("op", "old_path", "new_path", "old_kinds", "new_kinds", "old_own", "new_own").agg(F.count(F.lit(1)).alias("n")).collect()
    touched: dict[str, int] = {}
    links: dict[tuple[str, str], int] = {}
    score: dict[str, int] = {}
    numbers = set()
    for s in steps:
        old, new = s["old_path"], s["new_path"]
        if s["op"] == "retype":
            if s["new_own"] and new.startswith("record.") and {s["old_kinds"], s["new_kinds"]} <= {"number", "string", "number|string"}:
                numbers.add(new.removeprefix("record."))
            continue
        for path in {old, new} - {None}:
            touched[path] = touched.get(path, 0) + s["n"]
        renamed = s["op"] == "rename" and s["old_own"] and s["new_own"] and old.startswith("record.") and new.startswith("record.")
        if renamed or (s["op"] == "move" and any(p.startswith("record.") and p.count(".") == 1 for p in (old, new))):
            pair = (min(old, new), max(old, new))
            links[pair] = links.get(pair, 0) + s["n"]
            score[old] = score.get(old, 0) + s["n"]
    group = {p: [p] for pair in links for p in pair}
    together = _together(raw_files, [(p, q) for p in group for q in group if p < q]) if links else set()

    def spelled(pair: tuple[str, str]) -> bool:
        p, q = (x.removeprefix("record.") for x in pair)
        return "." not in p + q and _plain(p) == _plain(q)

    for (p, q), n in sorted(links.items(), key=lambda r: (not spelled(r[0]), -r[1], r[0])):
        if group[p] is group[q]:
            continue
        if not spelled((p, q)):
            few = n < min_share * min(touched[p], touched[q])
            if few or any((min(x, y), max(x, y)) in together for x in group[p] for y in group[q]):
                continue
        group[p].extend(group[q])
        for path in group[q]:
            group[path] = group[p]
    names, moved = {}, {}
    for members in {id(g): g for g in group.values() if len(g) > 1}.values():
        members = sorted(members, key=lambda x: (-score.get(x, 0), x))
        own = [m.removeprefix("record.") for m in members if m.startswith("record.") and m.count(".") == 1]
        if len(own) > 1:
            names[own[0]] = own
        if own and len(own) < len(members):
            moved[own[0]] = [m for m in members if m.removeprefix("record.") not in own]
    same = {n: c for c, group_ in names.items() for n in group_}
    return Projection(names, moved, frozenset(m for f in numbers for m in names.get(same.get(f, f), [f])))


def _value(item: dict, document: dict, path: tuple[str, ...]):
    """The first non-null value at a path below the record or the document; arrays on the way give their elements in order."""
    values = [item if path[0] == "record" else document]
    for key in path[1:]:
        values = [v for x in values for e in (x if isinstance(x, list) else [x]) if isinstance(e, dict) and (v := e.get(key)) is not None]
    return values[0] if values else None


def unified_records(raw_files: DataFrame, projection: Projection | Mapping[str, list[str]], fields: tuple[str, ...]) -> DataFrame:
    """One consistent table of all records: (file_id, array_name, rec_pos, a text column per field, extra).

    The projection (see :func:`compile_projection`; a mapping stands for names only) is compiled once per distinct schema and
    applied to every file: a field takes the first non-null value among its names, then among the places it has been
    moved to, then the document's own field of that name. Values are text in JSON notation, so that a field retyped between files
    stays one column, and text of fields that change between number and text is written as the number it is;
    whatever gives no column its value is kept as JSON in ``extra`` under its canonical name (its own, if the record has both),
    fields of the document as ``root.<key>``, unless it repeats the column's value. Files without a readable document give no rows.
    """
    plan = projection if isinstance(projection, Projection) else Projection(dict(projection))
    linked = {n: members for members in plan.names.values() for n in members}
    column_of = {n: f for f in fields for n in [f, *(n for n in linked.get(f, []) if n not in fields)]}
    canonical = plan.canonical()
    arrow = pa.schema([("file_id", pa.int64()), ("array_name", pa.string()), ("rec_pos", pa.int32()), *((f, pa.string()) for f in fields), ("extra", pa.string())])

    def text(value, name: str) -> str | None:
        if name in plan.numbers and isinstance(value, str) and (number := as_number(value)) is not None:
            value = int(number) if number.is_integer() and abs(number) < 2**53 else number
        elif name in plan.numbers and isinstance(value, float) and value.is_integer() and abs(value) < 2**53:
            value = int(value)
        return scalar_text(value) if not isinstance(value, (dict, list)) else json.dumps(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[str, dict[str, list[tuple[str, ...]]]] = {}
        for batch in batches:
            rows = []
            for file_id, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                document = parse_document(payload) or {}
                tree = schema_tree(document)
                if tree is None:
                    continue
                key = json.dumps(tree, separators=(",", ":"))
                if key not in compiled:
                    if len(compiled) > 10_000:
                        compiled.clear()
                    compiled[key] = plan.compile(tree, fields)
                paths = compiled[key]
                for array in RECORD_ARRAYS:
                    for pos, item in enumerate(as_elements(document.get(array))):
                        if not isinstance(item, dict):
                            continue
                        values = {f: text(next((v for p in paths[f] if (v := _value(item, document, p)) is not None), None), f) for f in fields}
                        extra = {}
                        for k, v in [*item.items(), *((f"root.{k}", v) for k, v in document.items() if k not in RECORD_ARRAYS)]:
                            f = column_of.get(k.removeprefix("root."))
                            if v is not None and not (f and values[f] == text(v, f)):
                                c = canonical.get(k, k)
                                extra[k if c != k and (c in extra or item.get(c) is not None or f) else c] = v
                        rows.append((file_id, array, pos, *values.values(), json.dumps(extra, sort_keys=True) if extra else None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types, strict=True)], schema=arrow)

    schema = "file_id long, array_name string, rec_pos int, " + ", ".join(f"`{f}` string" for f in fields) + ", extra string"
    return raw_files.select(F.col("file_id").cast("long"), "payload").mapInArrow(run, schema)
