"""Operator 4 [native]: document fingerprints by invertible Bloom lookup sketches.

A text is cut into paragraphs, each is hashed to a 64-bit digest. They end at line breaks and tabs,
at words whose last letter is a mark, at the full stops of scripts without blanks, and after
MOST characters (content_digests), so that a word put in moves the paragraphs around it only.
A text of fewer than SHORT characters is cut into its words, or, if it has fewer than
FEW_WORDS, into its GRAM-character grams, blanks made one. (digests, the default of fingerprinted, cuts each line into runs of WORDS
words.) A sketch is a row of cells; a digest goes into one cell in each of HASHES
equal parts, and a cell holds how many digests it got, the exclusive or of them, and the
exclusive or of a second hash of each. Sketches of two versions subtract cell by cell:
what both have cancels. A cell left with one digest gives it away (its second hash
agrees); taking that digest out of its other cells frees more cells, until all differing
digests are recovered.

The fingerprint is the sketch of BASE cells over all digests of a text, written out. Likeness
of two texts begins with their fingerprints: they are subtracted and peeled. Where that leaves
cells, the same is tried larger: digests are dealt by their second hash over groups, as many as
the texts ask for, with sketches of CELLS cells each, and a group that doesn't come out
either is built again four times as large, up to MOST_CELLS. (BASE cells are
the groups' cells folded: a digest's cell among BASE follows from that among CELLS.) Likeness
is the Jaccard coefficient of the digest sets, from the numbers of digests and of recovered
differences; a group that no size recovers is counted from its digests, and the row says so in
`recovered`.

Everything is DataFrame work: no Python runs on executors. Texts are shuffled once, by
ranges of their ids; what follows stays in the row.

Nulls: a null text is an empty one. Two texts without paragraphs have likeness 1, one with
and one without 0. Documents are in the order of their ids, rows with the same id in the
order of their texts; null ids come first. The next document of the last row is the first
row, of a single row itself. Very long texts are cut and compared whole, in time that grows
a little faster than their length. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASHES = 4
#: Cells of a fingerprint, of a group's sketch, and of the largest that is tried.
BASE, CELLS, MOST_CELLS = 8, 16, 64 * 4**5
#: Rounds of peeling at most.
ROUNDS = 24
#: Differing digests of a group, about.
GROUP = 4
#: Words of a paragraph at most.
WORDS = 10
#: Last letters that end a paragraph of content_digests, full stops that do, characters at most.
MARKS, STOPS, MOST = "fz7", "\u3002\uff01\uff1f", 300
#: Texts of fewer characters are cut into words, with fewer words into grams of GRAM characters.
SHORT, FEW_WORDS, GRAM = 400, 8, 3
#: Rows in a range of ids, about, and ranges at most (beyond, they get larger and spill).
RANGE_ROWS, MOST_RANGES = 2000, 4096
FIRST_KEY = -(1 << 63)


def let(value: Column, body) -> Column:
    """Evaluates a value once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digests(text: Column, words: int = WORDS) -> Column:
    """Different 64-bit digests of a text's paragraphs."""
    paragraphs = F.regexp_extract_all(text, F.lit(rf"(?:\S+[ \t]*){{1,{words}}}"), F.lit(0))
    return F.array_distinct(F.transform(paragraphs, lambda p: F.xxhash64(F.trim(p))))


def content_digests(text: Column) -> Column:
    """Different 64-bit digests of a text's paragraphs, cut by content, or of a short text's words or grams."""
    plain = lambda p: F.xxhash64(F.trim(p))
    runs = lambda p: F.transform(F.regexp_extract_all(p, F.lit(rf"(?s).{{1,{MOST}}}"), F.lit(0)), plain)

    def hashed(paragraphs: Column) -> Column:
        long = lambda p: F.length(p) > MOST
        return F.when(F.exists(paragraphs, long), F.flatten(F.transform(paragraphs, runs))).otherwise(F.transform(paragraphs, plain))

    whole = let(F.split(text, rf" (?<=[{MARKS}] )|[\n\t\r\x0b\f{STOPS}]"), hashed)
    grams = F.regexp_extract_all(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(rf"(?s)(?![\x{{DC00}}-\x{{DFFF}}])(?=(.{{{GRAM}}}))"), F.lit(1))  # not within a pair of surrogates
    small = let(F.split(text, r"\s+"), lambda w: F.when(F.size(w) < FEW_WORDS, F.concat(F.transform(w, plain), F.transform(grams, lambda g: F.xxhash64(g, F.lit(2))))).otherwise(F.transform(w, plain)))
    found = F.when(F.length(text) < SHORT, small).otherwise(whole)
    return F.array_remove(F.array_distinct(found), F.xxhash64(F.lit("")))


def second(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(1))


def cell_of(digest: Column, part: int, cells) -> Column:
    """A digest's cell among `cells`: each part looks at 16 bits of its own."""
    per = F.lit(cells).cast("int") if isinstance(cells, int) else cells
    per = (per / HASHES).cast("int")
    return (F.shiftrightunsigned(digest, 16 * part).bitwiseAND(F.lit(0xFFFF)) % per).cast("int") + per * part


def among(p: Column, i: Column) -> Column:
    """Whether cell i is one of a placed digest's."""
    here = p["i0"] == i
    for k in range(1, HASHES):
        here = here | (p[f"i{k}"] == i)
    return here


def cell(n: Column, x: Column, c: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), x.alias("x"), c.alias("c"))


def signed(values: Column, sign: int) -> Column:
    """Digests as what a sketch takes up: (s, x, c), s: 1 or -1."""
    return F.transform(values, lambda d: F.struct(F.lit(sign).alias("s"), d.alias("x"), second(d).alias("c")))


def sums(items: Column, cells) -> Column:
    """Cells (n, x, c) of signed digests."""
    count = F.lit(cells).cast("int") if isinstance(cells, int) else cells
    empty = cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))

    def part(found: Column, k: int) -> Column:
        # Of part k: each cell takes up the digests that fall into it.
        first = (count / HASHES).cast("int") * k

        def at(j: Column) -> Column:
            return F.aggregate(F.filter(found, lambda p: p[f"i{k}"] == first + j), empty, lambda s, p: cell(s["n"] + p["s"], s["x"].bitwiseXOR(p["x"]), s["c"].bitwiseXOR(p["c"])))

        return F.transform(F.sequence(F.lit(0), (count / HASHES).cast("int") - 1), at)

    placed = F.transform(items, lambda p: F.struct(p["s"].alias("s"), p["x"].alias("x"), p["c"].alias("c"), *(cell_of(p["x"], k, count).alias(f"i{k}") for k in range(HASHES))))
    return let(placed, lambda found: F.concat(*(part(found, k) for k in range(HASHES))))


def sketch(values: Column, cells) -> Column:
    """Cells (n, x, c) of digests."""
    return sums(signed(values, 1), cells)


def subtracted(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: cell(p["n"] - q["n"], p["x"].bitwiseXOR(q["x"]), p["c"].bitwiseXOR(q["c"])))


def filled(c: Column) -> Column:
    return (c["n"] != 0) | (c["x"] != 0) | (c["c"] != 0)


def peeled(cells: Column, size) -> Column:
    """What a difference of sketches holds: (ok, mine, other): whether all was recovered,
    and how many digests only the first and only the second version has."""

    def step(state: Column, _: Column) -> Column:
        free = F.filter(state["cells"], lambda c: F.when(F.abs(c["n"]) == 1, second(c["x"]) == c["c"]).otherwise(F.lit(False)))
        placed = F.transform(free, lambda c: F.struct(c["n"].alias("n"), c["x"].alias("x"), c["c"].alias("c"), *(cell_of(c["x"], k, size).alias(f"i{k}") for k in range(HASHES))))

        def take(found: Column) -> Column:
            def out_of(c: Column) -> Column:
                def less(s: Column, p: Column) -> Column:
                    here = F.struct(s["i"].alias("i"), (s["n"] - p["n"]).alias("n"), s["x"].bitwiseXOR(p["x"]).alias("x"), s["c"].bitwiseXOR(p["c"]).alias("c"))
                    return F.when(among(p, s["i"]), here).otherwise(s)

                return F.aggregate(found, c, less)

            mine = F.size(F.filter(found, lambda p: p["n"] == 1))
            rest = F.filter(F.transform(state["cells"], out_of), filled)
            taken = F.struct(rest.alias("cells"), F.lit(False).alias("stuck"), (state["mine"] + mine).alias("mine"), (state["other"] + F.size(found) - mine).alias("other"))
            stuck = F.struct(state["cells"].alias("cells"), F.lit(True).alias("stuck"), state["mine"].alias("mine"), state["other"].alias("other"))
            return F.when(F.size(found) == 0, stuck).otherwise(taken)

        done = state["stuck"] | (F.size(state["cells"]) == 0)
        return F.when(done, state).otherwise(let(F.array_distinct(placed), take))

    numbered = F.transform(cells, lambda c, i: F.struct(i.alias("i"), c["n"].alias("n"), c["x"].alias("x"), c["c"].alias("c")))
    start = F.struct(F.filter(numbered, filled).alias("cells"), F.lit(False).alias("stuck"), F.lit(0).alias("mine"), F.lit(0).alias("other"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, step,
        lambda s: F.struct((F.size(s["cells"]) == 0).alias("ok"), s["mine"].alias("mine"), s["other"].alias("other")),
    )


def recovered(items: Column, cells: int = CELLS, most: int = MOST_CELLS) -> Column:
    """(ok, mine, other) of signed digests by their sketch, retried larger on failure."""
    sizes = [cells]
    while sizes[-1] < most:
        sizes.append(sizes[-1] * 4)
    none = F.struct(F.lit(False).alias("ok"), F.lit(0).alias("mine"), F.lit(0).alias("other"))

    def attempt(result: Column, size: Column) -> Column:
        return F.when(result["ok"], result).otherwise(peeled(sums(items, size), size))

    return F.aggregate(F.array(*map(F.lit, sizes)), none, attempt)


def difference(a: Column, b: Column, cells: int = CELLS, most: int = MOST_CELLS) -> Column:
    """(ok, mine, other) of two digest sets by their sketches, retried larger on failure."""
    return let(F.concat(signed(a, 1), signed(b, -1)), lambda items: recovered(items, cells, most))


def counted(items: Column) -> Column:
    """(mine, other) of signed digests, from the digests themselves."""
    of = lambda sign: F.transform(F.filter(items, lambda p: p["s"] == sign), lambda p: p["x"])
    mine, other = F.size(F.array_except(of(1), of(-1))), F.size(F.array_except(of(-1), of(1)))
    return F.struct(F.lit(False).alias("ok"), mine.alias("mine"), other.alias("other"))


def dealt(a: Column, b: Column, groups: Column) -> Column:
    """Signed digests of both, by group, in two steps: no digest is looked at for every group."""
    outer = F.ceil(F.sqrt(groups)).cast("int")
    inner = F.ceil(groups / outer).cast("int")

    def marked(values: Column, sign: int, total: Column) -> Column:
        def of(c: Column, d: Column) -> Column:
            return F.struct(F.lit(sign).alias("s"), d.alias("x"), c.alias("c"), F.pmod(c, total).cast("int").alias("g"))

        return F.transform(values, lambda d: let(second(d), lambda c: of(c, d)))

    def split(sizes: Column) -> Column:
        outer, inner = sizes["outer"], sizes["inner"]
        items = F.concat(marked(a, 1, outer * inner), marked(b, -1, outer * inner))
        rough = let(items, lambda every: F.transform(F.sequence(F.lit(0), outer - 1), lambda r: F.filter(every, lambda p: p["g"] % outer == r)))
        within = lambda some: F.transform(F.sequence(F.lit(0), inner - 1), lambda j: F.filter(some, lambda p: p["g"].between(j * outer, j * outer + outer - 1)))
        return F.flatten(F.transform(rough, within))

    return let(F.struct(outer.alias("outer"), inner.alias("inner")), split)


def compared(a: Column, b: Column, print_a: Column, print_b: Column, share: float) -> Column:
    """(ok, mine, other) of two digest sets: by their fingerprints, or else by groups. share: of
    the digests of both, about how many differ."""
    groups = F.greatest(F.lit(1), F.ceil((F.size(a) + F.size(b)) * share / GROUP)).cast("int")

    def larger(_: Column) -> Column:
        each = F.transform(dealt(a, b, groups), lambda g: let(recovered(g), lambda r: F.when(r["ok"], r).otherwise(counted(g))))
        start = F.struct(F.lit(True).alias("ok"), F.lit(0).alias("mine"), F.lit(0).alias("other"))
        return F.aggregate(each, start, lambda s, r: F.struct((s["ok"] & r["ok"]).alias("ok"), (s["mine"] + r["mine"]).alias("mine"), (s["other"] + r["other"]).alias("other")))

    by_prints = peeled(subtracted(print_a, print_b), BASE)
    return let(by_prints, lambda r: F.when(r["ok"], r).otherwise(larger(r)))


def with_next(df: DataFrame, text: str = "text", key: str = "doc_id", of: Callable[[Column], Column] | None = None) -> DataFrame:
    """Rows (key, text, next_text) and, with `of`, its values (own, next) of both texts. Texts
    have no nulls."""
    docs = df.select(df[key].alias("key"), F.coalesce(df[text], F.lit("")).alias("text"), F.coalesce(df[key].cast("long"), F.lit(FIRST_KEY)).alias("at"))
    n = df.count()
    ranges = max(1, min(-(-n // RANGE_ROWS), MOST_RANGES))
    at = []
    if ranges > 1:
        cuts = [i / ranges for i in range(1, ranges)]
        at = sorted(set(docs.agg(F.percentile_approx("at", cuts, 20 * ranges)).first()[0]))
    side = max(1, int(len(at) ** 0.5))
    # Two looks: among every side-th bound, then among those after it.
    coarse, every = F.array(*map(F.lit, at[::side])).cast("array<bigint>"), F.array(*map(F.lit, at)).cast("array<bigint>")
    count = lambda bounds: F.size(F.filter(bounds, lambda b: b <= F.col("at")))
    first = F.greatest(count(coarse) - 1, F.lit(0)) * side
    docs = docs.withColumn("range", first + count(F.slice(every, first + 1, F.lit(side))))
    # The first row of each range also stands at the end of the range before it. One row a
    # range, at most MOST_RANGES.
    heads = docs.groupBy("range").agg(F.min("at").alias("at"))
    order = Window.orderBy("range")
    heads = heads.withColumn("before", F.coalesce(F.lag("range").over(order), F.max("range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    heads = docs.join(F.broadcast(heads), ["range", "at"]).groupBy("before").agg(F.min("text").alias("text"))
    both = docs.withColumn("end", F.lit(False)).unionByName(heads.select(F.col("before").alias("range"), "text", F.lit(True).alias("end")), allowMissingColumns=True)
    along = Window.partitionBy("range").orderBy("end", "at", "text")
    columns = ["key", "text", "next_text"]
    if of is not None:
        # Once a text, whatever its place in the next row; the texts themselves are shuffled.
        both = both.repartition("range").withColumn("own", of(F.col("text"))).withColumn("next", F.lead("own").over(along))
        columns += ["own", "next"]
    return both.withColumn("next_text", F.lead("text").over(along)).where("not end").select(*columns)


def fingerprinted(df: DataFrame, text: str = "text", key: str = "doc_id", cut: Callable[[Column], Column] = digests) -> DataFrame:
    """Rows (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, recovered): each text against an edited one, whose last quarter of code
    points is replaced by the first as many of the next document, and against that document.
    cut: the digests of a text."""

    def taken(value: Column) -> Column:
        """Digests d of a text and its fingerprint's cells p."""
        return let(cut(value), lambda d: F.struct(d.alias("d"), sketch(d, BASE).alias("p")))

    def written(cells: Column) -> Column:
        digits = lambda v: F.lpad(F.lower(F.hex(v)), 16, "0")
        return F.array_join(F.transform(cells, lambda c: F.concat_ws(".", F.lower(F.hex(c["n"])), digits(c["x"]), digits(c["c"]))), ":")

    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", 1, n - quarter), F.substring("next_text", 1, quarter))
    rows = with_next(df, text, key, taken).select("key", n.cast("long").alias("n_chars"), edited.alias("edited"), "own", "next")
    rows = rows.select("key", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", taken(F.col("edited")).alias("edit"), "next")
    against = lambda other, share: compared(F.col("own.d"), F.col(f"{other}.d"), F.col("own.p"), F.col(f"{other}.p"), share)
    # An edit changes less than a third of the digests of both; another document changes all.
    rows = rows.select("*", against("edit", 0.3).alias("r0"), against("next", 1.0).alias("r1"))

    def likeness(result: str) -> Column:
        mine = F.size("own.d")
        union = mine + F.col(f"{result}.other")
        return F.when(union == 0, F.lit(1.0)).otherwise((mine - F.col(f"{result}.mine")) / union)

    return rows.select(F.col("key").alias(key), "n_chars", "edited_sha256", written(F.col("own.p")).alias("fingerprint"), written(F.col("edit.p")).alias("edited_fingerprint"), likeness("r0").alias("near_edited"), likeness("r1").alias("near_next"), (F.col("r0.ok") & F.col("r1.ok")).alias("recovered"))
