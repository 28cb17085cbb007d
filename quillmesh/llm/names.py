"""Linking of variant spellings of names typed by people.

Every name is rewritten to canonical forms: titles, notes and forms of address taken off, inverted
order undone, letters typed for accents decoded, words with a typing slip corrected by the corpus's
own counts, then the forms a fuller name can shrink to (initials, two of its words, its given name
as a nickname of address uses it, its words run together). The forms are exploded and equi-joined
within a unit, so names meet only in a form that they share. A form's score is its rarity, one over
the number of full names of the unit that have it; a name links by its best form if that scores
LINKS_AT or more, and the membership tells the score of those that do not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.llm.canonical import Reference, _initials, allowed, damerau
from quillmesh.llm.fold import fold_words
from quillmesh.runtime import cut, maybe_broadcast

# fixed values: degrees and marks of office before a name
TITLES = {"gs", "pgs", "ts", "ths", "ks", "cn", "bs", "kts", "tl", "kt", "tm", "tuq", "dr", "prof", "mr", "mrs", "ms"}
# fixed values: words of address, and nicknames by the order of birth, that stand before a given name or a whole one
ADDRESS = ["ông", "bà", "cô", "thầy", "anh", "chị", "em", "bác", "chú", "cậu", "dì", "cả", "hai", "ba", "tư", "năm", "sáu", "bảy", "tám", "chín", "mười", "út"]
# fixed values: phrases that name nobody
NOBODY = {"", "da ky", "khong ro", "khong co", "chua ro", "n a", "ky ten", "an danh", "vo danh", "dang cap nhat", "khong ten", "null", "none", "xxx", "nguoi ky"}
_PLAIN_ADDRESS = {" ".join(fold_words(w)) for w in ADDRESS}
_NOTE = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|\bđ/c\b", re.I)
#: The least score of a form that links.
LINKS_AT = 1.0
#: Readings of one name that are spelt out in every combination; beyond it one word at a time is read otherwise.
COMBINED = 256
#: A word is taken for a slip of another if that one is so many times as frequent; for one with letters typed for accents, if so many times.
TYPO_RATIO, TELEX_RATIO = 8, 3
_TELEX = [("dd", "d"), ("aa", "a"), ("ee", "e"), ("oo", "o"), ("w", "")]


def telex(word: str) -> str:
    """``word`` with letters typed for accents taken off."""
    out = word[:-1] if len(word) > 1 and word[-1] in "sfrxj" else word
    for a, b in _TELEX:
        out = out.replace(a, b)
    return out


def parsed(typed: str | None) -> tuple[list[str], int]:
    """(folded words, address): empty words if it names nobody.

    ``address`` tells of the first word: 0 no word of address; 1 typed as one, in lower case before
    capitals; 2 typed as one; 3 like one but for accents. Whether 2 and 3 are part of the name can
    only be seen beside other names (``without_address``).
    """
    if not typed:
        return [], 0
    text = _NOTE.sub(" ", normalize("NFC", typed))
    if " ".join(fold_words(typed)) in NOBODY or " ".join(fold_words(text)) in NOBODY:
        return [], 0
    text = re.split(r":|\s[-–—]\s", text)[-1]
    given, comma, rest = text.partition(",")
    if comma:
        text = f"{rest} {given}"
    words = fold_words(text)
    while len(words) > 1 and words[0] in TITLES:
        words = words[1:]
    if not any(w.isalpha() for w in words):
        return [], 0
    address = 0
    if len(words) > 1 and words[0] in _PLAIN_ADDRESS:
        first = next((w for w in re.findall(r"[^\W_]+", text) if fold_words(w) == words[:1]), "")
        exact = first.lower() in ADDRESS
        address = (1 if first.islower() and any(c.isupper() for c in text) else 2) if exact else 3
    return words, address


def name_words(typed: str | None) -> list[str]:
    """The folded words of a name, with what may be its word of address; empty if it names nobody."""
    return parsed(typed)[0]


def without_address(words: list[list[Word]], address: int) -> list[list[Word]]:
    """``words`` (candidates of each place) without a word of address.

    Before a single word it is address, unless it only looks like one and the corpus has it as a
    family name. Before more it is one where a family name follows, or where it was typed in lower
    case; else it is the family name itself ("Chu Văn An").
    """
    if not address:
        return words
    # what the first word might be a slip of says nothing of it
    as_family = sum(w[1] for w in words[0] if w[0] in _PLAIN_ADDRESS)
    if len(words) == 2:
        return words if address == 3 and as_family else words[1:]
    return words[1:] if address == 1 or sum(w[1] for w in words[1]) > as_family else words


#: A word with how often it stands first, last and between in full names.
Word = tuple[str, int, int, int]


def _ordered(words: list[Word]) -> list[str]:
    """A full name with the family name first, by how often its outer words stand first and last elsewhere."""
    (a, a_first, a_last, _), (b, b_first, b_last, _) = words[0], words[-1]
    names = [w[0] for w in words]
    if (b_first + 1) * (a_last + 1) > (a_first + 1) * (b_last + 1):
        return [b, *names[1:-1], a]
    return names


def shrunk(name: list[str]) -> list[str]:
    """The shorter forms that a full name can take."""
    *front, given = name
    head, *mid = front
    out = [f"2:{' '.join(sorted((w, given)))}" for w in front]
    out += [f"I:{' '.join([*(w[0] for w in front), given])}", f"I:{' '.join([head, *(w[0] for w in mid), given])}"]
    return [*out, f"C:{''.join(name)}", f"G:{given}", f"N:{' '.join(name)}"]


def readings(words: list[list[Word]]) -> list[list[Word]]:
    """The ways to take the words, each with its candidates; the likeliest in each place first.

    Every combination while there are at most COMBINED of them; beyond that the likeliest reading
    and those that differ from it in one word.
    """
    n, ways = len(words), 1
    role = lambda i: 1 if i == 0 else 2 if i == n - 1 else 3
    ranked = [sorted(ws, key=lambda w: (-w[role(i)] if n > 2 else -sum(w[1:]), w[0])) for i, ws in enumerate(words)]
    for ws in ranked:
        ways *= len(ws)
    if ways <= COMBINED:
        return [list(x) for x in product(*ranked)]
    best = [ws[0] for ws in ranked]
    return [best, *([*best[:i], w, *best[i + 1 :]] for i, ws in enumerate(ranked) for w in ws[1:])]


def forms_of(words: list[list[Word]]) -> tuple[list[tuple[str, list[str]]], list[str], str | None]:
    """(entities with their shrunk forms, forms to look for, own form): a full name has only the first, by likelihood, a shorter one only the others."""
    ways = readings(words)
    typed = [w[0][0] for w in words]
    if len(words) >= 3 and all(len(w) > 1 for w in typed):
        full = [_ordered(w) for w in ways]
        return [(f"F:{' '.join(sorted(x))}", shrunk(x)) for x in full], [], None
    names = [[w[0] for w in way] for way in ways]
    if len(words) >= 2 and any(len(w) == 1 for w in typed):
        return [], [f"I:{' '.join(x)}" for x in names], f"G:{names[0][-1]}"
    if len(words) == 2:
        (a, _, a_last, _), (b, _, b_last, _) = ways[0]
        return [], [f"2:{' '.join(sorted(x))}" for x in names], f"G:{a if a_last > b_last else b}"
    return [], [f"{k}:{x[0]}" for x in names for k in "CG"], f"G:{names[0][0]}"


def _deletes(word: str, most: int) -> set[str]:
    """``word`` with up to ``most`` letters left out."""
    out = last = {word}
    for _ in range(most):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out = out | last
    return out


_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)


def gap_keys(word: str) -> set[int]:
    """Keys of ``word`` and of ``word`` with any one letter left out, in linear time."""
    c = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(c), _BASE, np.uint64))
        terms = (c + np.uint64(1)) * power
        upto = np.cumsum(terms, dtype=np.uint64)
        without = upto - terms + (upto[-1] - upto) * np.uint64(_UNBASE)
        keys = np.append(without ^ (np.uint64(len(c) - 1) * np.uint64(_UNBASE)), upto[-1] ^ (np.uint64(len(c)) * np.uint64(_UNBASE)))
    return set(keys.view(np.int64).tolist())


def whole_key(text: str) -> int:
    """The key of ``text`` itself."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        total = ((c + np.uint64(1)) * np.cumprod(np.full(len(c), _BASE, np.uint64))).sum(dtype=np.uint64) ^ (np.uint64(len(c)) * np.uint64(_UNBASE))
    return int(np.int64(np.uint64(total).view(np.int64)))


def one_apart(a: str, b: str) -> bool:
    """Whether one letter or one swap of neighbours tells two words apart, in linear time."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) != len(b):
        a, b = sorted((a, b), key=len)
        return a[i:] == b[i + 1 :]
    return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


def _vocabulary(words: DataFrame) -> DataFrame:
    """(word, ways) of all words of rows (words, address): what it can stand for, with counts by place in full names.

    What may be a word of address is counted first in its name only where no other family name
    follows it; those names are counted apart, after the others.
    """
    pos = words.select(F.size("words").alias("n"), "address", F.posexplode("words").alias("i", "word"), F.try_element_at("words", F.lit(2)).alias("next")).where("length(word) > 1")
    vocab = cut(
        pos.groupBy("word").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if((F.col("n") >= 3) & (F.col("i") == 0) & (F.col("address") == 0)).alias("first"),
            F.count_if((F.col("n") >= 3) & (F.col("i") == F.col("n") - 1)).alias("last"),
        )
    )
    led = pos.where("address > 0 and i = 0 and n >= 3").groupBy("word", "next").agg(F.count(F.lit(1)).alias("k"))
    families = vocab.where("first > 0").select(F.col("word").alias("next"))
    own = led.join(families, "next", "left_anti").groupBy("word").agg(F.sum("k").alias("own"))
    vocab = cut(vocab.join(own, "word", "left").select("word", "n", (F.col("first") + F.coalesce("own", F.lit(0))).alias("first"), "last"))

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                # decoded words meet under keys of their own
                out += [(f, w, n) for f in {*gap_keys(w), whole_key("\n" + telex(w)), whole_key("\n" + w)}]
            yield _record(out, ("form", pa.int64()), ("word", pa.string()), ("n", pa.int64()))

    near = vocab.select("word", "n").mapInArrow(neighbours, "form bigint, word string, n bigint")
    other = near.select("form", F.col("word").alias("other"), F.col("n").alias("other_n"))

    def slips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for word, n, other, other_n in zip(*(b.column(k).to_pylist() for k in range(4))):
                decodes = telex(word) == other
                if decodes and other_n >= TELEX_RATIO * n or other_n >= TYPO_RATIO * n and one_apart(word, other):
                    keep.append((word, other, decodes))
            yield _record(keep, ("word", pa.string()), ("other", pa.string()), ("telex", pa.bool_()))

    least = F.least(F.lit(TELEX_RATIO), F.lit(TYPO_RATIO)) * F.col("n")
    pairs = near.join(other, "form").where((F.col("word") != F.col("other")) & (F.col("other_n") >= least)).select("word", "n", "other", "other_n").distinct()
    fixes = pairs.mapInArrow(slips, "word string, other string, telex boolean")
    # what decodes needs no other correction
    fixes = fixes.withColumn("any_telex", F.max("telex").over(Window.partitionBy("word"))).where("telex or not any_telex")
    same = vocab.select("word", F.col("word").alias("other")).join(fixes, "word", "left_anti")
    known = vocab.select(F.col("word").alias("other"), "first", "last", F.greatest(F.col("n") - F.col("first") - F.col("last"), F.lit(0)).alias("mid"))
    every = fixes.select("word", "other").unionByName(same).join(known, "other")
    return every.groupBy("word").agg(F.collect_list(F.struct(F.col("other").alias("w"), F.col("first").alias("f"), F.col("last").alias("l"), F.col("mid").alias("m"))).alias("ways"))


def _near_names(full: DataFrame) -> DataFrame:
    """(id, unit, entity, forms) with full names of a unit that differ in one letter of one middle name taken for the more frequent of them.

    Such a slip can make another proper name ("Thường", "Tường"), which corpus counts cannot tell.
    First and last names are left alone: they tell people of a family apart.
    """
    name = F.split(F.substring(F.element_at(F.filter("forms", lambda f: f.startswith("N:")), 1), 3, 10_000), " ")
    each = full.groupBy("unit", "entity").agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("name")).where(F.size("name") > 2)
    gaps = F.explode(F.sequence(F.lit(1), F.size("name") - 2))
    rest = F.array_join(F.concat(F.slice("name", F.lit(1), F.col("i")), F.array(F.lit("*")), F.slice("name", F.col("i") + 2, F.size("name"))), " ")
    gap = each.withColumn("i", gaps).select("unit", "entity", "n", rest.alias("rest"), F.element_at("name", F.col("i") + 1).alias("w"))
    other = gap.select("unit", "rest", F.col("entity").alias("to"), F.col("n").alias("m"), F.col("w").alias("v"))
    met = gap.join(other, ["unit", "rest"]).where((F.levenshtein("w", "v") == 1) & ((F.col("n") < F.col("m")) | (F.col("n") == F.col("m")) & (F.col("entity") > F.col("to"))))
    to = met.groupBy("unit", "entity").agg(F.max_by("to", F.struct("m", "to")).alias("to"))
    return full.join(to, ["unit", "entity"], "left").select("id", "unit", F.coalesce("to", "entity").alias("entity"), "forms")


def link_people(rows: DataFrame) -> DataFrame:
    """(id, unit, entity, score) of rows (id, unit, name) that name somebody.

    Names are compared within their unit (null units with each other). Null, empty and placeholder
    names are no rows; repeated rows count once. A short name that fits no full name of its unit is
    an entity by its given name; one that fits several stays on its own, with their rarity as score.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [parsed(x) for x in b.column(2).to_pylist()]
            at = pa.array([i for i, (w, _) in enumerate(got) if w], pa.int32())
            lists = pa.array([w for w, _ in got if w], pa.list_(pa.string()))
            flags = pa.array([a for w, a in got if w], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), lists, flags], names=["id", "unit", "words", "address"])

    once = rows.select(F.col("id").cast("bigint").alias("id"), F.coalesce("unit", F.lit("")).alias("unit"), "name").where("name is not null")
    names = cut(once.groupBy("id").agg(F.min(F.struct("unit", "name")).alias("x")).select("id", "x.unit", "x.name").mapInArrow(parse, "id bigint, unit string, words array<string>, address int"))
    vocab = maybe_broadcast(cut(_vocabulary(names)))
    words = (
        names.select("id", "unit", "address", F.posexplode("words").alias("i", "word"))
        .join(vocab, "word", "left")
        .groupBy("id", "unit", "address")
        .agg(F.array_sort(F.collect_list(F.struct("i", "word", "ways"))).alias("ws"))
    )

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, unit, address, ws in zip(*(b.column(k).to_pylist() for k in range(4))):
                ways = [[tuple(x.values()) for x in w["ways"]] if w["ways"] else [(w["word"], 0, 0, 0)] for w in ws]
                full, asked, own = forms_of(without_address(ways, address))
                rows += [(i, unit, rank, len(full) > 1, e, forms, None) for rank, (e, forms) in enumerate(full)]
                if own:
                    rows.append((i, unit, 0, False, None, asked, own))
            yield _record(rows, ("id", pa.int64()), ("unit", pa.string()), ("rank", pa.int32()), ("open", pa.bool_()), ("entity", pa.string()), ("forms", pa.list_(pa.string())), ("own", pa.string()))

    made = cut(words.select("id", "unit", "address", "ws").mapInArrow(explode, "id bigint, unit string, rank int, open boolean, entity string, forms array<string>, own string"))
    full, short = made.where("entity is not null"), made.where("entity is null")
    # a name that can be read in several ways is the one its unit has otherwise, or the likeliest
    sure = full.where("not open").select("unit", "entity").distinct().withColumn("sure", F.lit(True))
    read = full.where("open").join(sure, ["unit", "entity"], "left")
    read = read.groupBy("id", "unit").agg(F.min_by(F.struct("entity", "forms"), F.struct(F.col("sure").isNull(), "rank")).alias("x"))
    full = full.where("not open").select("id", "unit", "entity", "forms").unionByName(read.select("id", "unit", "x.entity", "x.forms"))
    full = cut(_near_names(full))
    hubs = (
        full.select("unit", "entity", F.explode("forms").alias("form"))
        .distinct()
        .groupBy("unit", "form")
        .agg((F.lit(1.0) / F.count(F.lit(1))).alias("rarity"), F.min("entity").alias("hub"))
    )
    asked = short.select("id", "unit", "own", F.posexplode("forms").alias("rank", "form"))
    best = asked.join(hubs, ["unit", "form"], "left").groupBy("id", "unit", "own").agg(F.max(F.struct("rarity", -F.col("rank"), "hub")).alias("x"))
    entity = F.when(F.col("x.rarity") >= LINKS_AT, F.col("x.hub")).when(F.col("x.rarity").isNotNull(), F.concat(F.lit("?"), F.col("id").cast("string"))).otherwise(F.col("own"))
    short = best.select("id", "unit", entity.alias("entity"), F.coalesce("x.rarity", F.lit(1.0)).alias("score"))
    return full.select("id", "unit", "entity", F.lit(1.0).alias("score")).unionByName(short)


def link_organizations(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """(id, entity) of rows (id, name): the entry of (code, name, short) meant, else the folded name itself.

    The rewritings of every alias and of every entry are exploded, each with the spellings that
    leave out up to two letters, and equi-joined; what meets is verified by its Damerau distance.
    """

    def alias_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not name or " ".join(fold_words(name)) in NOBODY:
                    continue
                for k, f in enumerate(Reference._forms(name)):
                    out += [(i, k, f, v) for v in _deletes(f, allowed(len(f)))]
            yield _record(out, ("id", pa.int64()), ("rank", pa.int32()), ("asked", pa.string()), ("form", pa.string()))

    def entry_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for code, name, short in zip(*(b.column(k).to_pylist() for k in range(3))):
                full = " ".join(fold_words(name))
                out += [(code, full, v) for v in _deletes(full, allowed(len(full)))]
                out += [(code, f, f) for f in {*_initials(full.split()), *(" ".join(fold_words(s)) for s in (code, short) if s)}]
            yield _record(out, ("entity", pa.string()), ("name", pa.string()), ("form", pa.string()))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, rank, asked, code, name in zip(*(b.column(k).to_pylist() for k in range(5))):
                d = damerau(asked, name)
                if d <= (allowed(min(len(asked), len(name))) if " " in name else 0):
                    out.append((i, 100 * d + rank, code))
            yield _record(out, ("id", pa.int64()), ("cost", pa.int32()), ("entity", pa.string()))

    left = rows.select(F.col("id").cast("bigint"), "name").mapInArrow(alias_forms, "id bigint, rank int, asked string, form string")
    right = reference.select("code", "name", "short").mapInArrow(entry_forms, "entity string, name string, form string")
    met = left.join(right, "form").select("id", "rank", "asked", "entity", "name").distinct()
    fits = met.mapInArrow(verify, "id bigint, cost int, entity string").groupBy("id", "cost").agg(F.min("entity").alias("e"), F.count_distinct("entity").alias("n"))
    best = fits.groupBy("id").agg(F.min_by(F.when(F.col("n") == 1, F.col("e")), "cost").alias("e"))
    own = left.groupBy("id").agg(F.min_by("asked", "rank").alias("own"))
    return own.join(best, "id", "left").select("id", F.coalesce("e", F.concat(F.lit("="), "own")).alias("entity"))


def _record(rows: list[tuple], *cols: tuple[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(cols)})


#: Members of a group that one task pairs with the rest.
GROUP = 2_000


def pairs(members: DataFrame, *by: str) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of the members (id, *by) of each group; null groups are none.

    The members are written once and read by both sides. A large group is cut into parts, each of
    which meets the whole group in a task of its own, so no task writes all pairs of a hot group.
    """
    m = cut(members.select("id", *by).dropna(subset=list(by)))
    parts = m.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts"))
    m = m.join(parts, list(by))
    a = m.select(F.col("id").alias("id_a"), *by, F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
    b = m.select(F.col("id").alias("id_b"), *by, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return a.join(b, [*by, "part"]).where("id_a < id_b").select("id_a", "id_b")
