"""Fingerprints of documents as invertible Bloom lookup tables over their paragraphs, and what differs between two.

A paragraph here is a piece of a text that ends at a line feed, or at `.`, `!` or `?` before white space; that white
space and empty pieces do not count. Its digest is 64 bits; the second and later copies of a paragraph in a text have
digests of their own. A digest is put in three cells of a sketch, one in each third of it; a cell holds how many
digests it has, their XOR and the XOR of their checks. The fingerprint of a text is its sketch of 3 x `PRINT` cells.

1. Two versions are compared by sketches that grow with them, `ROOM` cells in each third for a digest of either side.
   Cells are subtracted, and what both sides have cancels out. A cell that holds one digest (its check says so) gives it
   away. If the digests found so make up the first third's totals, count, XOR and checks, they are all that differ.
2. Pairs for which they do not are peeled. Their digests are dealt to parts of `PART` digests on average, so a long
   text has more parts, not larger ones. In each part's subtracted sketch, every digest found is taken from its other
   cells, which may leave those with one, and so on until no cell is left.
3. Where cells are left over the sketch was too small. That part is tried again with `GROWTH` times the cells and other
   hashes, until it peels; one that does not in `TRIES` tries, which no text is known to cause, stops the job.

Likeness is 2 c / (a + b) for texts of a and b paragraphs that have c in common; two texts without any are alike.

Only built-in functions. Texts are shuffled once, by document, and once more those of the pairs that are peeled. Cells
are sums and XORs of rows (document, sketch, cell), grouped where the documents already lie, so a very long text is many
rows and never one large value.

Defined results: null texts are empty and have an empty sketch. Documents follow each other by doc_id, null first, then
by hashes of id and text; among rows with the same id and text each is the next one of the copy before. Rows count one
by one. An empty table gives no rows. Texts of any length are taken whole. Other columns have no part in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samedays.llm.common import WHITE_CLASS, Scratch, made_once
from samedays.operators.numbering import numbered

#: Cells in each third of a fingerprint, for each digest of a pair, and of the sketch of a part.
PRINT, ROOM, THIRD = 4, 32, 16
THIRDS = 3
#: Digests of both sides in a part, on average.
PART = 12
#: How many times as large the next try is, how often it grows, and tries in all; the bits of a hash for each cell.
GROWTH, GROWTHS, TRIES, CELL_BITS = 4, 4, 12, 20
#: Documents whose cells a task groups at a time, some 100 MB: for executors of 3 GB with two cores. Larger ones take more.
TASK_DOCUMENTS = 1_000
#: A cell's place in a document: its sketch and third above these bits, its number in the third below.
_NUMBER_BITS = CELL_BITS + 2

_PIECES = rf"(?<=[.!?]){WHITE_CLASS}+|\n"
_KEY = ["key", "check"]
#: A request: a document, and whether it is compared with a copy of itself.
_BY = [*_KEY, "own"]
_PUT = "struct<cell:int,n:int,digest:bigint,mark:bigint>"
_CELL = "struct<cell:int,n:int,digest:bigint,mark:bigint,pure:boolean>"
_FOUND = "array<struct<digest:bigint,n:int>>"
#: What a row of digests belongs to.
_TO_EDITED, _TO_NEXT, _PRINT, _EDITED_PRINT, _ABOUT = range(5)


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text, in order."""
    return F.array_remove(F.split(text, _PIECES), "")


def digests(frame: DataFrame, **texts: Column) -> DataFrame:
    """The frame with an array of 64-bit digests for each text, no digest twice."""
    hashes = made_once(frame, **{f"{name}_hashes": F.transform(paragraphs(text), lambda piece: F.xxhash64(piece)) for name, text in texts.items()})

    def in_order(name: str) -> Column:
        """The hashes sorted, where some are the same; else null."""
        same = F.size(F.array_distinct(f"{name}_hashes")) < F.size(f"{name}_hashes")
        return F.when(same, F.sort_array(f"{name}_hashes"))

    ordered = made_once(hashes, **{f"{name}_sorted": in_order(name) for name in texts})

    def run_starts(name: str) -> Column:
        value = F.col(f"{name}_sorted")
        return F.filter(F.sequence(F.lit(0), F.size(value) - 1), lambda at: (at == 0) | (F.get(value, at) != F.get(value, at - 1)))

    started = made_once(ordered, **{f"{name}_starts": F.when(F.col(f"{name}_sorted").isNotNull(), run_starts(name)) for name in texts})

    def told_apart(name: str) -> Column:
        """The hash of each run of equal ones, and for its further copies hashes of it and their number."""
        value, starts = F.col(f"{name}_sorted"), F.col(f"{name}_starts")

        def copies(start: Column, end: Column) -> Column:
            numbers = F.sequence(F.lit(0), F.coalesce(end, F.size(value)) - start - 1)
            return F.transform(numbers, lambda copy: F.when(copy == 0, F.get(value, start)).otherwise(F.xxhash64(F.get(value, start), copy)))

        return F.flatten(F.zip_with(starts, F.slice(starts, 2, F.size(starts)), copies))

    found = made_once(started, **{name: F.when(F.col(f"{name}_sorted").isNull(), F.col(f"{name}_hashes")).otherwise(told_apart(name)) for name in texts})
    return found.drop(*[f"{name}_{part}" for name in texts for part in ("hashes", "sorted", "starts")])


def _let(name: str, value: str, body: str) -> str:
    """SQL of `body` with a name for a value that is made once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _at(digest: str, width: str, salt: str) -> str:
    """SQL of the array of a digest's cells, one in each third of `width` cells."""
    bits = f"xxhash64({digest}, {salt})"
    each = (f"cast({i} * {width} + (shiftright({bits}, {CELL_BITS * i}) & {(1 << CELL_BITS) - 1}) % {width} AS int)" for i in range(THIRDS))
    return f"array({', '.join(each)})"


def _mark(digest: str) -> str:
    return f"xxhash64({digest}, 'check')"


def _marked(cells: str) -> str:
    """SQL of the cells that are not empty, each with whether it holds a single digest."""
    held = f"filter({cells}, c -> c.n <> 0 OR c.digest <> 0 OR c.mark <> 0)"
    pure = f"abs(c.n) = 1 AND c.mark = {_mark('c.digest')}"
    return f"transform({held}, c -> struct(c.cell AS cell, c.n AS n, c.digest AS digest, c.mark AS mark, {pure} AS pure))"


def sketch(members: str, width: str = str(THIRD), salt: str = "0") -> str:
    """SQL of the cells that are not empty of an array of (digest, sign, mark). Signs of -1 are subtracted.

    What goes into the cells is sorted by cell, so that one pass adds up each of them.
    """
    put = f"transform({_at('m.digest', width, salt)}, at -> struct(at AS cell, m.sign AS n, m.digest AS digest, m.mark AS mark))"
    placed = f"array_sort(flatten(transform({members}, m -> {put})))"
    same = "struct(e.cell AS cell, s.last.n + e.n AS n, s.last.digest ^ e.digest AS digest, s.last.mark ^ e.mark AS mark)"
    step = f"if(e.cell = s.last.cell, struct(s.done AS done, {same} AS last), struct(concat(s.done, array(s.last)) AS done, e AS last))"
    start = f"struct(cast(array() AS array<{_PUT}>) AS done, cast(struct(-1 AS cell, 0 AS n, 0 AS digest, 0 AS mark) AS {_PUT}) AS last)"
    added = f"aggregate({placed}, {start}, (s, e) -> {step}, s -> concat(s.done, array(s.last)))"
    return _marked(added)


def peeled(cells: str, width: str = str(THIRD), salt: str = "0") -> str:
    """SQL of (cells, found) after peeling a subtracted sketch: cells left over, and (digest, n) with n = 1 or -1.

    A round takes every digest that stands alone in a cell, and empties that cell; as many rounds as cells are enough.
    """
    single = "array_distinct(transform(filter(s.cells, c -> c.pure), c -> struct(c.digest AS digest, c.n AS n, c.mark AS mark)))"
    placed = f"transform({single}, p -> struct(p.digest AS digest, p.n AS n, p.mark AS mark, {_at('p.digest', width, salt)} AS at))"
    less = "struct(held.cell AS cell, held.n - p.n AS n, held.digest ^ p.digest AS digest, held.mark ^ p.mark AS mark, false AS pure)"
    taken = f"aggregate(singles, c, (held, p) -> if(array_contains(p.at, held.cell), {less}, held))"
    left = _marked(f"transform(s.cells, c -> {taken})")
    gone = "transform(singles, p -> struct(p.digest AS digest, p.n AS n))"
    after = f"struct({left} AS cells, concat(s.found, {gone}) AS found, false AS stuck)"
    step = f"if(s.stuck OR size(s.cells) = 0, s, {_let('singles', placed, f'if(size(singles) = 0, struct(s.cells AS cells, s.found AS found, true AS stuck), {after})')})"
    start = f"struct(cast({cells} AS array<{_CELL}>) AS cells, cast(array() AS {_FOUND}) AS found, false AS stuck)"
    return f"aggregate(sequence(0, size({cells})), {start}, (s, number) -> {step})"


def recovered(members: str, third: int | None = None) -> str:
    """SQL of the digests (digest, n) that one side alone has in an array of (digest, sign, mark), by as large a sketch as it takes."""
    width = f"cast({third or THIRD} * power({GROWTH}, least(attempt, {GROWTHS})) AS int)"
    peel = _let("subtracted", sketch(members, "width", "attempt"), peeled("subtracted", "width", "attempt"))
    tried = _let("width", width, _let("ended", peel, "struct(ended.found AS found, size(ended.cells) = 0 AS whole)"))
    start = f"struct(cast(array() AS {_FOUND}) AS found, false AS whole)"
    loop = f"aggregate(sequence(0, {TRIES - 1}), {start}, (state, attempt) -> if(state.whole, state, {tried}))"
    never = f"cast(raise_error('a sketch did not peel at any size') AS {_FOUND})"
    return _let("state", loop, f"if(state.whole, state.found, {never})")


def _likeness(left: str, right: str, kind: str) -> Column:
    """2 c / (a + b) from the numbers of paragraphs and of those that differ."""
    both = f"({left} + {right})"
    return F.expr(f"if({both} = 0, 1D, ({both} - {kind}_removed - {kind}_added) / {both})")


def _neighbours(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """Requests (key, check, own, times, need, next_key, next_check): which text each distinct row is followed by.

    A row that is there several times is followed by itself (`own`) all but once.
    """
    distinct = documents.groupBy(*_KEY).agg(F.count("*").alias("copies"), F.first("doc_id").alias("doc_id"), F.max(F.length("text")).alias("n_chars"))
    placed = numbered(distinct, [F.asc_nulls_first("doc_id"), *_KEY], keep=scratch.keep)
    rows = placed.select(*_KEY, "copies", "doc_id", F.floor(F.col("n_chars") / 4).cast("int").alias("need"), F.pmod(F.col("place") + 1, "group_size").alias("after"))
    following = placed.select(F.col("place").alias("after"), F.col("key").alias("next_key"), F.col("check").alias("next_check"))
    last = "struct(0 AS own, 1L AS times, next_key, next_check)"
    others = "struct(1 AS own, copies - 1 AS times, key AS next_key, check AS next_check)"
    both = f"inline(if(copies > 1, array({last}, {others}), array({last})))"
    return rows.join(following, "after").selectExpr(*_KEY, "doc_id", "need", both)


#: Columns of counts: what differs, and on which side.
_DIFFERING = {"edited_removed": (_TO_EDITED, 1), "edited_added": (_TO_EDITED, -1), "next_removed": (_TO_NEXT, 1), "next_added": (_TO_NEXT, -1)}
_ABOUT_FIELDS = """doc_id, times, cast(length(text) AS bigint) AS n_chars, unhex(sha2(edited, 256)) AS edited_sha256,
    size(a) AS n_a, size(b) AS n_b, size(c) AS n_c"""


def _versions(texts: DataFrame, requests: DataFrame) -> DataFrame:
    """The columns of requests with the text, its edited version, and the digests of both (a, b) and of the next text (c).

    `texts` has (key, check, text), one row for each; both ways to it read one shuffle.
    """
    # the next text gives its beginning and its digests, and nothing else of it travels
    givers = digests(texts.selectExpr("key AS next_key", "check AS next_check", "text"), c=F.col("text"))
    given = requests.join(givers, ["next_key", "next_check"]).select(
        *_KEY, "own", "doc_id", "times", "need", F.expr("substring(text, 1, need)").alias("beginning"), "c"
    )
    edited = F.expr("concat(substring(text, 1, length(text) - need), beginning)")
    return digests(made_once(texts.join(given, _KEY), edited=edited), a=F.col("text"), b=F.col("edited"))


def _side(kind: int, array: str, sign: int, width: str) -> str:
    return f"struct({kind} AS kind, {sign} AS sign, cast({width} AS bigint) AS width, {array} AS digests)"


def _each_digest(versions: DataFrame, sides: list[str], about: str) -> DataFrame:
    """(by, about, kind, sign, width, digest); only the one row of a request that says so takes along what it is about."""
    rows = versions.selectExpr(*_BY, f"{about} AS about", "a", "b", "c").selectExpr(*_BY, "about", f"inline(array({', '.join(sides)}))")
    return rows.selectExpr(*_BY, f"if(kind = {_ABOUT}, about, NULL) AS about", "kind", "sign", "width", "explode(digests) AS digest")


def _first_try(texts: DataFrame, requests: DataFrame) -> DataFrame:
    """A row per request: about, the fingerprints, the counts of _DIFFERING, and whether they are `whole`."""

    def room(right: str) -> str:
        return f"least({ROOM} * (size(a) + size({right})) + 1, {1 << CELL_BITS})"

    pairs = [_side(kind, array, sign, room(right)) for kind, right in ((_TO_EDITED, "b"), (_TO_NEXT, "c")) for array, sign in (("a", 1), (right, -1))]
    prints = [_side(_PRINT, "a", 1, f"{PRINT}"), _side(_EDITED_PRINT, "b", 1, f"{PRINT}")]
    each = _each_digest(_versions(texts, requests), [*pairs, *prints, _side(_ABOUT, "array(0L)", 0, "1")], f"struct({_ABOUT_FIELDS})")
    placed = each.selectExpr(*_BY, "about", "kind", "sign", "width", "digest", f"{_mark('digest')} AS mark", f"inline(arrays_zip({_at('digest', 'width', '0')}, array(0, 1, 2))) AS (cell, third)")
    # keys are packed, as they are most of what a task holds
    packed = placed.selectExpr(*_KEY, "about", "sign", "digest", "mark", f"shiftleft(cast((own * 8 + kind) * 4 + third AS bigint), {_NUMBER_BITS}) + cell AS at")
    cells = packed.groupBy(*_KEY, "about", "at").agg(F.sum("sign").cast("int").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("mark").alias("mark"))
    sketch_of = f"cast(shiftright(at, {_NUMBER_BITS}) AS int)"
    opened = cells.selectExpr(
        *_KEY, "about", "n", "digest", "mark", f"at & {(1 << _NUMBER_BITS) - 1}L AS cell",
        f"{sketch_of} DIV 32 AS own", f"({sketch_of} DIV 4) % 8 AS kind", f"{sketch_of} % 4 AS third",
    )
    # cells of fingerprints stay as they are; those of a pair give the digests that stand alone, each once, and the totals
    is_print, alone = f"kind IN ({_PRINT}, {_EDITED_PRINT})", f"abs(n) = 1 AND mark = {_mark('digest')}"
    singles = opened.where(f"{is_print} OR kind = {_ABOUT} OR n <> 0 OR digest <> 0 OR mark <> 0").selectExpr(
        *_BY, "about", "kind", "third", "n", "digest", "mark",
        f"CASE WHEN {is_print} THEN cell WHEN {alone} THEN digest END AS item", f"kind < {_PRINT} AND third = 0 AS counts",
    )
    once = singles.groupBy(*_BY, "about", "kind", "item").agg(
        F.max("n").alias("n"),
        F.max("digest").alias("digest"),
        F.max("mark").alias("mark"),
        F.coalesce(F.sum(F.expr("if(counts, n, 0)")), F.lit(0)).alias("all_n"),
        F.bit_xor(F.expr("if(counts, digest, 0L)")).alias("all_digests"),
        F.bit_xor(F.expr("if(counts, mark, 0L)")).alias("all_marks"),
    )
    found = f"kind < {_PRINT} AND item IS NOT NULL"
    slots = once.groupBy(*_BY, "about", "kind", F.expr(f"if({is_print}, item, 0L)").alias("slot")).agg(
        F.first("n").alias("n"),
        F.first("digest").alias("digest"),
        F.first("mark").alias("mark"),
        F.sum(F.expr(f"if({found} AND n = 1, 1L, 0L)")).alias("removed"),
        F.sum(F.expr(f"if({found} AND n = -1, 1L, 0L)")).alias("added"),
        (F.sum("all_n") - F.sum(F.expr(f"if({found}, n, 0)"))).alias("rest_n"),
        F.bit_xor(F.expr(f"all_digests ^ if({found}, digest, 0L)")).alias("rest_digests"),
        F.bit_xor(F.expr(f"all_marks ^ if({found}, mark, 0L)")).alias("rest_marks"),
    )
    hexed = "concat(lpad(hex(slot), 2, '0'), lpad(hex(n), 8, '0'), lpad(hex(digest), 16, '0'), lpad(hex(mark), 16, '0'))"

    def fingerprint(kind: int) -> Column:
        return F.unhex(F.array_join(F.sort_array(F.collect_list(F.expr(f"if(kind = {kind}, {hexed}, NULL)"))), ""))

    def counted(kind: int, n: int) -> Column:
        return F.coalesce(F.max(F.expr(f"if(kind = {kind}, {'removed' if n == 1 else 'added'}, 0L)")), F.lit(0))

    rest = f"kind < {_PRINT} AND (rest_n <> 0 OR rest_digests <> 0 OR rest_marks <> 0)"
    return slots.groupBy(*_BY).agg(
        F.max("about").alias("about"),
        fingerprint(_PRINT).alias("fingerprint"),
        fingerprint(_EDITED_PRINT).alias("edited_fingerprint"),
        F.every(F.expr(f"NOT coalesce({rest}, false)")).alias("whole"),
        *[counted(*which).alias(name) for name, which in _DIFFERING.items()],
    )


def _peeled(texts: DataFrame, requests: DataFrame) -> DataFrame:
    """A row per request: the counts of _DIFFERING, by peeling the sketches of parts."""

    def parts(right: str) -> str:
        return f"greatest(1L, cast(ceil((size(a) + size({right})) / {PART}) AS bigint))"

    pairs = [_side(kind, array, sign, parts(right)) for kind, right in ((_TO_EDITED, "b"), (_TO_NEXT, "c")) for array, sign in (("a", 1), (right, -1))]
    each = _each_digest(_versions(texts, requests), pairs, "NULL")
    dealt = each.selectExpr(*_BY, "kind", "pmod(xxhash64(digest, 'part'), width) AS part", f"struct(digest, sign, {_mark('digest')} AS mark) AS member")
    members = dealt.groupBy(*_BY, "kind", "part").agg(F.collect_list("member").alias("members"))
    found = made_once(members, found=F.expr(recovered("members")))

    def counted(kind: int, n: int) -> Column:
        differing = F.size(F.filter("found", lambda f: f["n"] == n)).cast("long")
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, differing)), F.lit(0))

    return found.groupBy(*_BY).agg(*[counted(*which).alias(name) for name, which in _DIFFERING.items()])


def compare_neighbours(table: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document against its edited text, whose last quarter is taken from the next document, and against the next.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the numbers of
    paragraphs that were recovered as differing: edited_removed, edited_added, next_removed, next_added.
    """
    scratch = Scratch(table.sparkSession, "sketches")
    source = table.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # 96 bits of hashes of id and text; rows that share them are the same, and no part is null
    keyed = source.withColumns({"key": F.xxhash64("doc_id", "text"), "check": F.hash("text", "doc_id")})
    requests = scratch.keep(_neighbours(keyed, scratch))
    # as many tasks as keep their cells in memory; a plain count
    tasks = max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), requests.count() // TASK_DOCUMENTS + 1)
    texts = keyed.select(*_KEY, "text")
    first = scratch.keep(_first_try(texts.repartition(tasks, *_KEY).dropDuplicates(_KEY), requests))
    whole = first.where("whole").drop("whole")
    # the few pairs that were not found whole, with the texts that they need
    again = scratch.keep(requests.join(first.where("NOT whole").select(*_BY), _BY, "left_semi"))
    needed = scratch.keep(again.select(*_KEY).union(again.select("next_key", "next_check")).distinct())
    peeled_again = _peeled(texts.join(needed, _KEY, "left_semi").dropDuplicates(_KEY), again)
    rest = first.where("NOT whole").drop("whole", *_DIFFERING).join(peeled_again, _BY)
    near = whole.unionByName(rest).selectExpr("*", "about.*")
    return near.select("*", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).select(
        "doc_id",
        "n_chars",
        *[F.lower(F.hex(name)).alias(name) for name in ("edited_sha256", "fingerprint", "edited_fingerprint")],
        _likeness("n_a", "n_b", "edited").alias("near_edited"),
        _likeness("n_a", "n_c", "next").alias("near_next"),
        *_DIFFERING,
    )
