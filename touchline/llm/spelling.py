"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Letters form groups, and a word is the vector of its letters' counts by group. One edit
adds at most one to one count and takes at most one from another, so a search through the
trie of vectors, depth first, carries a budget of one surplus and one deficit. Words at
the leaves that it reaches are verified letter by letter.

The top of the trie, over a few coarse groups, deals words to tasks: a word is stored
below its own counts and looked up there and below those of the counts around it that come
first, so two words meet once. Each task builds the rest of the trie, over fine groups,
for one such place. A place of very many words is dealt in chunks, each a trie of its own
that all lookups of the place visit.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import materialise
from touchline.session import spread_by

#: Letters are Latin-1 from here on; everything else parts words.
LETTERS = bytes([*range(97, 123), *range(0xC0, 0x100)])
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in LETTERS else 32 for c in range(256))
FEWEST_LETTERS = 7
#: A form has so many times the occurrences of its variant.
TIMES = 10
#: Distinct words that a task counts before it passes them on.
HELD = 300_000
#: Bytes of texts that are cut into words together.
JOINED = 2 << 20
#: Words of one trie; fine groups; words below which the search stops parting them.
CHUNK = 10_000
FINE = 24
LEAF = 16
#: Lookups that go through a trie together, and pairs that are verified together.
LOOKUPS = 20_000
PAIRS = 200_000
#: A word's sum of these tells by how few letters two words differ, in whatever order.
SUMS = 1 << 20
WEIGHT = np.random.default_rng(0).integers(0, SUMS, 256)
ONE_LETTER = np.zeros(SUMS, bool)
_OWN = WEIGHT[list(LETTERS)]
ONE_LETTER[np.concatenate([_OWN, -_OWN, (_OWN[:, None] - _OWN).ravel()]) % SUMS] = True
#: Letters compared at once, from both ends; words with more are compared one by one.
WIDE = 32
#: Bits of a coarse count; larger counts are cut to their largest value, which moves no
#: two counts apart.
BITS = 7
LARGEST = (1 << BITS) - 1


def _runs(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The runs of `FEWEST_LETTERS` letters or more of each folded text."""
    data = b" ".join([*texts, b""])
    letter = np.frombuffer(data, np.uint8) != 32
    edges = np.flatnonzero(np.diff(letter.view(np.int8), prepend=0))
    starts, ends = edges[::2], edges[1::2]  # the data end with a space
    long = ends - starts >= FEWEST_LETTERS
    starts, ends = starts[long], ends[long]
    cuts = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts])).tolist()
    runs = [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    return (runs[a:b] for a, b in zip([0, *cuts], cuts))


def _count_words(delete_every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = defaultdict(int)

        def counted() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], ["word", "n"])

        def count(ids: list, texts: list[bytes]) -> None:
            for doc_id, runs in zip(ids, _runs(texts)):
                start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs).items():
                    h = crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                    if delete_every and h % delete_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < FEWEST_LETTERS:
                            continue
                    total[word] += n

        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if text:
                    ids.append(doc_id)
                    texts.append(text.encode("latin-1", "replace").translate(FOLD))
                    size += len(texts[-1])
                if size > JOINED:
                    count(ids, texts)
                    ids, texts, size = [], [], 0
                    if len(total) > HELD:
                        yield counted()
                        total.clear()
            if texts:
                count(ids, texts)
        if total:
            yield counted()

    return run


def vocabulary(docs: DataFrame, delete_every: int = 31, fewest: int = 2) -> DataFrame:
    """(word, n): words of at least `FEWEST_LETTERS` letters and `fewest` occurrences in
    the whole texts of `docs` (doc_id, text), folded to small ASCII letters.

    For test data with known variants, a word loses one letter wherever the crc32 of its
    document's id and itself is divisible by `delete_every`; 0 leaves all as they are.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = plain.mapInArrow(_count_words(delete_every), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


def balanced(counts: np.ndarray, groups: int) -> np.ndarray:
    """Group of each letter: the most frequent first, each into the lightest group."""
    own, load = np.zeros(len(counts), np.int64), [0] * groups
    for letter in np.argsort(-counts, kind="stable").tolist():
        own[letter] = k = load.index(min(load))
        load[k] += int(counts[letter]) + 1
    return own


def nested(counts: np.ndarray, coarse: np.ndarray, fine: int) -> tuple[np.ndarray, np.ndarray]:
    """Fine groups that each lie in one coarse group: of each letter, and the coarse group
    of each fine one."""
    own, within = np.zeros(len(counts), np.int64), []
    for k in range(int(coarse.max()) + 1):
        inside = np.flatnonzero(coarse == k)
        own[inside] = balanced(counts[inside], fine) + len(within)
        within += [k] * fine
    return own, np.array(within)


def vectors(letters: np.ndarray, owner: np.ndarray, words: int, group: np.ndarray, groups: int) -> np.ndarray:
    """Counts by group of each word; `owner` has the word of each of the letters."""
    return np.bincount(owner * groups + group[letters], minlength=words * groups).reshape(words, groups).astype(np.int32)


def _letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer(b"".join(words), np.uint8), np.repeat(np.arange(len(words)), size)


class Words:
    """Words with what the search and the verification need of them."""

    def __init__(self, rows: list[tuple[bytes, int, int]], group: np.ndarray, within: np.ndarray):
        self.words, self.n = [r[0] for r in rows], [r[1] for r in rows]
        letters, owner = _letters(self.words)
        self.size = np.bincount(owner, minlength=len(rows))
        self.vector = vectors(letters, owner, len(rows), group, len(within))
        self.sum = (np.bincount(owner, WEIGHT[letters], len(rows)).astype(np.int64) % SUMS).astype(np.int32)
        at = np.arange(len(letters)) - (np.cumsum(self.size) - self.size)[owner]
        self.head, self.tail = (self._aligned(letters, owner, x) for x in (at, self.size[owner] - 1 - at))
        self.first, self.last = (x[:, 0] & np.uint64(0xFFFFFF) for x in (self.head, self.tail))

    def _aligned(self, letters: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """`WIDE` letters of each word from one end, eight to a number, zeros after its last."""
        out = np.zeros((len(self.words), WIDE), np.uint8)
        some = at < WIDE
        out[owner[some], at[some]] = letters[some]
        return out.view("<u8")


def _shared(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Equal letters at the start of each pair of rows."""
    shared = np.zeros(len(a), np.int64)
    going = np.ones(len(a), bool)
    for k in range(width):
        x = a[:, k] ^ b[:, k]
        first = np.bitwise_count((x & -x) - np.uint64(1)).astype(np.int64) >> 3  # 8 where all are equal
        shared += np.where(going, first, 0)
        going &= x == 0
    return shared


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether one letter put in, left out or replaced makes one of the other."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    at = next((i for i, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
    return short[at + (len(a) == len(b)) :] == long[at + 1 :]


def verified(queries: Words, q: np.ndarray, members: Words, m: np.ndarray) -> np.ndarray:
    """Which of the pairs are one edit apart: all but one letter of the longer word lie in
    what the two share at their starts and ends."""
    longest = np.maximum(queries.size[q], members.size[m])
    width = min(WIDE // 8, -(-int(longest.max(initial=1)) // 8))
    head = _shared(queries.head[q], members.head[m], width)
    tail = _shared(queries.tail[q], members.tail[m], width)
    near = (np.abs(queries.size[q] - members.size[m]) <= 1) & (head + tail >= longest - 1) & (head < longest)
    for k in np.flatnonzero(longest > WIDE):
        near[k] = one_edit(queries.words[q[k]], members.words[m[k]])
    return near


class Trie:
    """Words in order of their vectors; a node is a range of them."""

    def __init__(self, members: Words, within: np.ndarray):
        self.members, self.within = members, within.tolist()
        self.order = np.lexsort(members.vector.T[::-1])
        self.vector = members.vector[self.order]

    def near(self, queries: Words, less: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, member) of words one edit apart. A deficit may be spent in the
        coarse group `less` of a query, a surplus in `more`; -2: in any."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        pending = 0

        def settle() -> None:
            nonlocal held, pending
            if held:
                q, m = (np.concatenate([x[side] for x in held]) for side in (0, 1))
                # One edit leaves the first three letters as they are, or the last three.
                some = np.flatnonzero((queries.first[q] == self.members.first[m]) | (queries.last[q] == self.members.last[m]))
                q, m = q[some], m[some]
                near = verified(queries, q, self.members, m)
                found.append((q[near], m[near]))
            held, pending = [], 0

        # Depth first; `spent` has a bit for the surplus and one for the deficit of each
        # query, and `barred` those that a coarse group has not to spend.
        every = np.arange(len(queries.words))
        barred = [((more != g) & (more != -2)) * 1 + ((less != g) & (less != -2)) * 2 for g in range(max(self.within) + 1)]
        own = np.ascontiguousarray(queries.vector.T)
        stack = [(0, len(self.order), 0, every, np.zeros(len(every), np.int64))]
        while stack:
            low, high, level, q, spent = stack.pop()
            if high - low <= LEAF or level == len(self.within):
                step = max(1, PAIRS // (high - low))
                leaf = self.order[low:high]
                for at in range(0, len(q), step):
                    some = q[at : at + step]
                    a, b = np.nonzero(ONE_LETTER[(self.members.sum[leaf] - queries.sum[some, None]) & (SUMS - 1)])
                    held.append((some[a], leaf[b]))
                    pending += len(a)
                    if pending >= PAIRS:
                        settle()
                continue
            # Queries in order of their count and of what they have spent: those that go
            # on to a child are slices.
            counts = self.vector[low:high, level]
            starts = [0, *(np.flatnonzero(counts[1:] != counts[:-1]) + 1).tolist()]
            most = int(counts[-1]) + 2
            state = np.minimum(own[level][q], most) * 4 + (spent | barred[self.within[level]][q])
            order = np.argsort(state.astype(np.int16) if most < 8000 else state, kind="stable")
            q, spent = q[order], spent[order]
            cut = [0, *np.cumsum(np.bincount(state, minlength=4 * most + 4)).tolist()]
            for a, b in zip(starts, [*starts[1:], high - low]):
                at = 4 * int(counts[a])
                # A member with more than the query is a surplus, one with less a deficit.
                steps = [(at, at + 4, 0), (at + 4, at + 6, 2)]
                if at:
                    steps += [(at - 4, at - 3, 1), (at - 2, at - 1, 1)]
                steps = [(cut[x], cut[y], bit) for x, y, bit in steps if cut[x] < cut[y]]
                if steps:
                    chosen = np.concatenate([q[x:y] for x, y, _ in steps])
                    after = np.concatenate([spent[x:y] | bit for x, y, bit in steps])
                    stack.append((low + a, low + b, level + 1, chosen, after))
        settle()
        if not found:
            return every[:0], every[:0]
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


#: Roles: a word that is stored, one looked up among those of its own counts, and one
#: looked up where coarse group `less` has one less and `more` (-1: none) has one more.
MEMBER, OWN, VISITOR = 0, 1, 2
STEP = 16
FOUND = "word string, n_near long, near string, near_n long"


def _role(less: int, more: int) -> int:
    return VISITOR + less * STEP + more + 1


def _search(group: np.ndarray, within: np.ndarray):
    """Near words in each place; rows come sorted by place, its members first. A visitor's
    links count for both words, those of an own lookup for the one that is looked up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, trie = None, None
        members: list[tuple[bytes, int, int]] = []
        waiting: list[tuple[bytes, int, int]] = []
        #: Of each member and query: near words so far, and the best of them.
        tally: dict[bytes, list] = {}

        def note(own: dict[bytes, list], word: bytes, other: bytes, n: int) -> None:
            known = own.get(word)
            if known is None:
                own[word] = [1, -n, other]
            else:
                known[0] += 1
                if (-n, other) < (known[1], known[2]):
                    known[1:] = -n, other

        def outcome(own: dict[bytes, list]) -> pa.RecordBatch:
            columns = [
                pa.array([w.decode("latin-1") for w in own], pa.string()), pa.array([x[0] for x in own.values()], pa.int64()),
                pa.array([x[2].decode("latin-1") for x in own.values()], pa.string()), pa.array([-x[1] for x in own.values()], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "near", "near_n"])

        def look_up() -> pa.RecordBatch | None:
            nonlocal trie, waiting
            rows, waiting = waiting, []
            if not rows or not members:
                return None
            if trie is None:
                trie = Trie(Words(members, group, within), within)
            queries, role = Words(rows, group, within), np.array([r[2] for r in rows]) - VISITOR
            less, more = np.where(role < 0, -2, role // STEP), np.where(role < 0, -2, role % STEP - 1)
            found: dict[bytes, list] = {}
            for q, m in zip(*(x.tolist() for x in trie.near(queries, less, more))):
                (word, n, kind), (other, other_n, _) = rows[q], members[m]
                note(found, word, other, other_n)
                if kind != OWN:
                    note(tally, other, word, n)
            return outcome(found) if found else None

        def finish() -> Iterator[pa.RecordBatch]:
            nonlocal members, trie
            found = look_up()
            if found is not None:
                yield found
            if tally:
                yield outcome(tally)
                tally.clear()
            members, trie = [], None

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "chunk", "role", "word", "n")]
            for key, chunk, role, word, n in zip(*columns):
                if (key, chunk) != place:
                    yield from finish()
                    place = (key, chunk)
                if role == MEMBER:
                    members.append((word.encode("latin-1"), n, role))
                elif members:
                    waiting.append((word.encode("latin-1"), n, role))
                    if len(waiting) >= LOOKUPS:
                        found = look_up()
                        if found is not None:
                            yield found
        yield from finish()

    return run


def coarse_groups(words: int) -> int:
    """Coarse groups with which the fullest place has about `CHUNK` words: a count takes
    its likeliest value for about a fourth of all words."""
    groups = 1
    while groups < 63 // BITS and words * 0.26**groups > CHUNK:
        groups += 1
    return groups


def _visits(key: Column, groups: int) -> Column:
    """(role, key) of every place where a word is stored or looked up."""
    count = [F.shiftright(key, BITS * (groups - 1 - g)).bitwiseAND(F.lit(LARGEST)) for g in range(groups)]
    unit = [1 << BITS * (groups - 1 - g) for g in range(groups)]
    visit = lambda role, key: F.struct(F.lit(role).alias("role"), key.alias("key"))
    places = [visit(MEMBER, key), visit(OWN, key)]
    for less in range(groups):
        places.append(F.when(count[less] > 0, visit(_role(less, -1), key - unit[less])))
        for more in range(less + 1, groups):
            room = (count[less] > 0) & (count[more] < LARGEST)
            places.append(F.when(room, visit(_role(less, more), key - unit[less] + unit[more])))
    return F.filter(F.array(*places), lambda x: x.isNotNull())


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n) for every word of `words` (word, n; Latin-1 letters,
    each once) that has others one edit apart: their number, and the one of largest n,
    the smallest of them in code-point order where n ties."""
    words = words.select("word", F.col("n").cast("long").alias("n"))

    def count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(256, np.int64), 0
        for batch in batches:
            letters, _ = _letters([w.encode("latin-1") for w in batch.column("word").to_pylist()])
            total += np.bincount(letters, minlength=256)
            rows += batch.num_rows
        columns = [pa.array(np.r_[np.arange(256), -1]), pa.array(np.r_[total, rows])]
        yield pa.RecordBatch.from_arrays(columns, ["letter", "n"])

    # At most 257 rows: the words, and the occurrences of each letter.
    counted = words.mapInArrow(count_letters, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    counts = dict.fromkeys(range(-1, 256), 0) | {r["letter"]: r["n"] for r in counted}
    groups, letters = coarse_groups(counts[-1]), np.array([counts[k] for k in range(256)])
    coarse = balanced(letters, groups)
    fine, within = nested(letters, coarse, -(-FINE // groups))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            vector = np.minimum(vectors(*_letters(own), len(own), coarse, groups), LARGEST).astype(np.int64)
            key = np.zeros(len(own), np.int64)
            for g in range(groups):
                key = (key << BITS) | vector[:, g]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(key)], ["word", "n", "own"])

    keyed = materialise(words.mapInArrow(keys, "word string, n long, own long"), "keyed-words")
    # A row for every `CHUNK` words or more: 16 bytes each.
    crowded = keyed.groupBy(F.col("own").alias("key")).count().where(F.col("count") > CHUNK)
    crowded = crowded.select("key", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    visits = keyed.select("word", "n", F.explode(_visits(F.col("own"), groups)).alias("at")).select("word", "n", "at.role", "at.key")
    k = F.coalesce("chunks", F.lit(1))
    one = F.pmod(F.xxhash64("word"), k).cast("int")
    chunks = F.when(F.col("role") == MEMBER, F.array(one)).otherwise(F.sequence(F.lit(0), k - 1))
    dealt = visits.join(F.broadcast(crowded), "key", "left").select("key", F.explode(chunks).alias("chunk"), "role", "word", "n")
    dealt = spread_by(dealt, "key", "chunk").sortWithinPartitions("key", "chunk", "role")
    near = dealt.mapInArrow(_search(fine, within), FOUND)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", "best.near", (-F.col("best.less")).alias("near_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for `forms` (word, form) without rings: each word's last form. Every
    round doubles the steps taken."""
    now = materialise(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "roots")
    while not now.where("open").isEmpty():
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(onward, "root", "left")
        now = materialise(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("open")), "roots")
    return now.select("word", "root")


def group_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of `words` (word, n).

    A word's form is its near word of largest n, if that is at least `times` its own; its
    root is the last of its form's forms, or itself. No cap holds on near words.
    """
    words = materialise(words, "words")
    found = words.join(near_words(words), "word", "left")
    is_form = F.col("near_n") >= F.col("n") * times
    rows = materialise(
        found.select(
            "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ), "variants",
    )
    last = roots(rows.where("form is not null").select("word", "form"))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, delete_every: int = 31, fewest: int = 2, times: int = TIMES) -> DataFrame:
    """`group_variants` of the `vocabulary` of `docs` (doc_id, text).

    Null and empty texts have no words; a null id counts as an empty one where letters are
    left out; repeated rows count each; other columns are not read; an empty table gives
    no rows. A word may be of any length.
    """
    return group_variants(vocabulary(docs, delete_every, fewest), times)
