"""Variant spellings of typed names: trie join, then token alignment in any order.

Names become words in one form (garbled ones restored, look-alikes home, accents off, digits read as letters inside words).
Distinct word lists, not rows, go on. They are sharded into tries: all names that hold an anchor word, with the
words beside it as the trie. Each name asks with the two rarest words that any match must cover, one as the anchor
and the other walking the trie with a Levenshtein automaton; anchors within one edit come from tries of the
vocabulary, sharded by halves of words. What meets is checked word by word in every order: typing errors, short
forms, nicknames, initials, lost blanks and cut ends may differ; numbers, places, trades and given names may not.
Equal spellings and links form groups, whose pairs are returned unless two of their words contradict each other.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amalgrid.llm.components import connected
from amalgrid.llm.copies import _words
from amalgrid.llm.garbled import garbled_records
from amalgrid.llm.lookalikes import NativeFold, distinct_records, lookalike_table
from amalgrid.session import cut

#: An established word (trade, place, given name, legal form) stands in this share of all distinct names, in no
#: fewer than so many, and beside so many effective partners.
SHARE, LEAST, PARTNERS = 1 / 2500, 5, 8
#: Partners of one anchor that one trie holds.
BLOCK = 2000
#: A name of so many letters may have been cut off at its end; one of more than so many words is compared by single ones.
LONG, MANY = 14, 24

# Legal forms and words that tell no entities apart.
LEGAL = frozenset(
    "pty ltd limited proprietary pl inc incorporated corp corporation co company llc llp lp plc gmbh gesellschaft mbh ag sa srl bv nv pte bhd sdn "
    "holdings hldgs holding ооо оао зао ао компания επε αε оа 주식회사 株式会社 有限公司 集团".split()
)
FILLERS = frozenset("the for trustee of and & y und et".split())
# Short forms that are not simply letters left out.
SHORT_FORMS = {"intl": "international", "mgt": "management", "svcs": "services", "engrg": "engineering", "joiners": "joinery", "engineers": "engineering", "builders": "building", "mfr": "manufacturing", "bros": "brothers", "comms": "communications", "uni": "university", "hldgs": "holdings", "elec": "electrical"}
# Last words of institutions, which a cut name may lack.
INSTITUTIONS = frozenset("trust council department ministry university hospital authority".split())
# Given names and their everyday forms.
NICKNAMES = tuple(
    frozenset(g.split())
    for g in (
        "anthony tony ant", "charles charlie chuck chas", "deborah deb debbie debs", "elizabeth liz beth betty eliza lizzie libby bess", "francis frank fran frankie", "gregory greg", "henry harry hank hal",
        "isabella bella izzy isa", "joseph joe joey jo", "katherine kate kathy katie kat kay cathy", "leonard leo len lenny", "margaret maggie meg peggy marge greta", "nicholas nick nicky nico",
        "patricia pat patty trish tricia", "robert rob bob bobby robbie bert", "stephen steve stevie", "thomas tom tommy", "victoria vicky vicki tori", "william will bill billy willy liam", "zachary zach zack zac",
        "james jim jimmy jamie", "john jack johnny", "michael mike mick mickey", "richard rick dick rich ricky", "edward ed ted eddie ned", "alexander alex al sandy xander", "andrew andy drew", "benjamin ben benny",
        "christopher chris kit topher", "daniel dan danny", "david dave davy", "matthew matt", "samuel sam sammy", "timothy tim timmy", "jennifer jen jenny", "susan sue suzy", "barbara barb babs", "rebecca becky becca",
        "catherine cathy kate cat", "theodore ted theo", "frederick fred freddy", "peter pete", "philip phil", "raymond ray", "ronald ron ronnie", "donald don donnie", "kenneth ken kenny", "lawrence larry", "gerald gerry jerry",
        "abigail abby gail", "dorothy dot dolly", "eleanor ellie nell nora", "jacqueline jackie", "pamela pam", "sandra sandy", "teresa terry tess", "vincent vince vinny", "walter walt wally", "albert al bert",
    )
)
_NICK: dict[str, list[int]] = {}
for _k, _g in enumerate(NICKNAMES):
    for _n in _g:
        _NICK.setdefault(_n, []).append(_k)
_READ_AS = str.maketrans("0134578", "oleastb")
_FLAT = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i", "ð": "d", "þ": "th", "ħ": "h", "®": " ", "™": " ", "©": " ", "№": " no "})


def name_words(name: str, fold: NativeFold) -> list[str]:
    """The words of a name in its own order and one form."""
    text = fold(name).translate(_FLAT)
    text = regex.sub(r"(?<=\p{L})['’`´](?=\p{L})", "", text)
    if not text.isascii():
        text = unicodedata.normalize("NFC", regex.sub(r"(?<=[\p{Latin}\p{Greek}\p{Cyrillic}])\p{M}+", "", unicodedata.normalize("NFD", text)))
    out = []
    for w in _words(regex.sub(r"(?<=\d)[.,](?=\d)", "p", text)):
        if not w.isdigit() and any(c.isdigit() for c in w) and sum(c.isalpha() for c in w) > sum(c.isdigit() for c in w):
            w = w.translate(_READ_AS)
        out.append(w)
    return out


# --- tries and automata -----------------------------------------------------------------------

_HERE = ""


def _insert(trie: dict, word: str) -> None:
    node = trie
    for c in word:
        node = node.setdefault(c, {})
    node[_HERE] = word


def build_trie(words) -> dict:
    root: dict = {}
    for w in words:
        _insert(root, w)
    return root


def within(trie: dict, word: str, edits: int) -> dict[str, int]:
    """All words of the trie within so many edits (a swap of neighbours is one): the automaton's states, walked."""
    found: dict[str, int] = {}
    n = len(word)
    seen: dict[tuple[int, int], int] = {}
    stack = [(trie, 0, edits)]
    while stack:
        node, i, left = stack.pop()
        state = (id(node), i)
        if seen.get(state, -1) >= left:
            continue
        seen[state] = left
        if n - i <= left and _HERE in node:
            w, d = node[_HERE], edits - left + n - i
            if d < found.get(w, edits + 1):
                found[w] = d
        if i < n:
            c = word[i]
            if c in node:
                stack.append((node[c], i + 1, left))
            if left:
                stack.append((node, i + 1, left - 1))
                if i + 1 < n and (nxt := node.get(word[i + 1])) is not None and c in nxt:
                    stack.append((nxt[c], i + 2, left - 1))
        if left:
            for c, child in node.items():
                if c:
                    stack.append((child, i, left - 1))
                    if i < n:
                        stack.append((child, i + 1, left - 1))
    return found


@lru_cache(maxsize=1 << 17)
def edits(a: str, b: str, most: int) -> int:
    """Edit distance with swaps, or ``most + 1``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    # An edit changes the letters in use by two at most.
    if len(set(a) ^ set(b)) > 2 * most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before2, before = row, before, row
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before2[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


# --- alignment --------------------------------------------------------------------------------


def _subsequence(short: str, long: str) -> bool:
    it = iter(long)
    return all(c in it for c in short)


class Align:
    """Decides whether two word lists can name one entity. ``counts`` of words are over distinct lists."""

    def __init__(self, established: int, words: frozenset[str] | None = None):
        self.established = established
        self.words = words
        self.counts: dict[str, int] = {}

    def known(self, w: str) -> bool:
        return w in self.words if self.words is not None else self.counts.get(w, 0) >= self.established

    def core(self, words: list[str]) -> list[str]:
        return [w for w in words if w not in FILLERS and w not in LEGAL]

    def short_of(self, a: str, b: str) -> bool:
        """a a short form of the established word b, or of another short form's word."""
        if SHORT_FORMS.get(a) == b:
            return True
        if len(a) >= len(b) or a[0] != b[0] or len(a) < 2 or not self.known(b):
            return False
        return b.startswith(a) and len(a) >= 3 or len(a) <= 0.7 * len(b) + 1 and _subsequence(a, b) and (a[-1] == b[-1] or len(a) >= 4)

    def same(self, a: str, b: str, most: int) -> int | None:
        """Cost of taking a for b, or None."""
        if a == b:
            return 0
        if a[0].isdigit() or b[0].isdigit():
            return None
        if len(a) == 1 or len(b) == 1:
            s, t = (a, b) if len(a) == 1 else (b, a)
            return 1 if t[0] == s and self.known(t) and t not in LEGAL else None
        if self.short_of(a, b) or self.short_of(b, a):
            return 1
        if a in _NICK and b in _NICK and set(_NICK[a]) & set(_NICK[b]):
            return 1
        ca, cb = self.counts.get(a, 1), self.counts.get(b, 1)
        rarer, commoner = min(ca, cb), max(ca, cb)
        # Two words that both stand on their own are two words; an error is rare beside what was meant.
        if self.known(a) and self.known(b) and commoner < 20 * rarer or rarer >= 4 and commoner < 5 * rarer:
            return None
        low = min(len(a), len(b))
        wide = ord(a[0]) > 0x2E7F
        most = min(most, 1 if low < 7 or wide or rarer > 2 else 2)
        if low < (4 if not wide else 5):
            return None
        d = edits(a, b, most)
        if d > 1 and most and "rn" in a + b:
            d = min(d, edits(a.replace("rn", "m"), b.replace("rn", "m"), most - 1) + 1)
        return d if d <= most else None

    def stands_for(self, a: str, b: str) -> bool:
        """Whether two unequal words agree without an error of typing: initials, short forms, nicknames."""
        return len(a) == 1 or len(b) == 1 or self.short_of(a, b) or self.short_of(b, a) or bool(set(_NICK.get(a, ())) & set(_NICK.get(b, ())))

    def droppable(self, w: str, last: bool) -> bool:
        if w in LEGAL or w in FILLERS:
            return True
        if (last and len(w) <= 12 or len(w) >= 3) and any(x.startswith(w) for x in LEGAL):
            return True
        return len(w) >= 5 and any(abs(len(x) - len(w)) <= 1 and edits(x, w, 1) <= 1 for x in LEGAL if len(x) >= 5)

    def match(self, a: list[str], b: list[str]) -> bool:
        ra, rb = self.core(a), self.core(b)
        if not ra or not rb:
            return a == b
        last_a, last_b = a[-1], b[-1]
        met = 0
        for w in list(ra):
            if w in rb:
                ra.remove(w)
                rb.remove(w)
                met += 1
        total, typed, twice = 0, 0, 0
        for w in sorted(ra, key=lambda w: (len(w) == 1, w)):
            options = [(cost, v) for v in rb if (cost := self.same(w, v, 1 if self.known(w) or self.known(v) else 2)) is not None]
            if options:
                cost, v = min(options)
                ra.remove(w)
                rb.remove(v)
                total += cost
                met += 1
                typed += not self.stands_for(w, v)
                twice += cost > 1
        # Two errors in a word ask for another word that is sure, and for no error elsewhere.
        if twice and (typed > 1 or max(len(sure_words(self, a)), len(sure_words(self, b))) < 2):
            return False
        # A blank lost or gained: one word against two neighbours, without another error.
        for x, y, order in ((ra, rb, self.core(b)), (rb, ra, self.core(a))):
            after = dict(zip(order, order[1:]))
            for w in list(x):
                for u in list(y):
                    v = after.get(u)
                    if v is not None and v != u and v in y and len(u) + len(v) >= 6 and w == u + v:
                        x.remove(w)
                        y.remove(u)
                        y.remove(v)
                        met += 1
                        break
        # The end of a long name cut off, within a word or before the last one.
        for x, y, words, last in ((ra, rb, a, last_a), (rb, ra, b, last_b)):
            cut_off = False
            if last in x and sum(map(len, words)) >= LONG:
                # Of numbers only a date can be told from another number when cut.
                v = next((v for v in y if v.startswith(last) and v != last and (not last.isdigit() or len(v) == 8)), None)
                if v is not None:
                    x.remove(last)
                    y.remove(v)
                    total += 1
                    met += 1
                    cut_off = True
            if not x and met >= 3:
                for v in list(y):
                    if v in INSTITUTIONS or cut_off and v.isdigit() or len(v) == 8 and v.isdigit() and "p" in last and last[0].isdigit():
                        y.remove(v)
        ra = [w for w in ra if not self.droppable(w, w == last_a)]
        rb = [w for w in rb if not self.droppable(w, w == last_b)]
        return not ra and not rb and total <= 4 and met >= 1

    def contradict(self, a: list[str], b: list[str]) -> bool:
        """Each name has an established word or number that the other can't hold."""

        def odd(x: list[str], y: list[str], last_x: str, last_y: str) -> bool:
            return any((self.known(w) or w[0].isdigit()) and not self.droppable(w, w == last_x) and not last_x == w and not w.startswith(last_y) and all(self.same(w, v, 1) is None for v in y) for w in x)

        ra, rb = self.core(a), self.core(b)
        return odd(ra, rb, a[-1], b[-1]) and odd(rb, ra, b[-1], a[-1])


# --- operator ---------------------------------------------------------------------------------


def _batch(columns: list[list], names: str, kinds: str) -> pa.RecordBatch:
    types = {"s": pa.string(), "l": pa.int64(), "i": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds)], names=names.split())


def _rn(w: str) -> list[str]:
    """What two letters that look like one make of a word."""
    return [w.replace("rn", "m")] if "rn" in w else []


def _marks(w: str) -> list[str]:
    """What a word can stand for without edits: itself, its nickname classes, a single letter as an initial."""
    return [w, *(f"#{k}" for k in _NICK.get(w, ())), *([f"^{w}"] if len(w) == 1 else [])]


def sure_words(align: "Align", words: list[str]) -> list[str]:
    """The words of a name that any match must cover."""
    last = words[-1]
    return [w for w in dict.fromkeys(align.core(words)) if len(w) > 1 and not w[0].isdigit() and w not in INSTITUTIONS and not align.droppable(w, w == last)]


def _entries(words: list[str], core: list[str]) -> list[tuple[int, int, str]]:
    """(first place, last place, unit) of all that can cover a word of another name."""
    out = [(i, i, u) for i, w in enumerate(core) for u in _marks(w) + _rn(w)]
    out += [(i, i + 1, u + v) for i, (u, v) in enumerate(zip(core, core[1:])) if len(u) + len(v) >= 6]
    if core and core[-1] == words[-1] and sum(map(len, words)) >= LONG:
        out.append((len(core) - 1, len(core) - 1, f"\t{words[-1]}"))
    return out


def _keys(known: frozenset[str]):
    """(h, spell, cs) -> (kind, h, x, y): what each list offers and asks for, as pairs or, with one sure word, singly.

    A match covers all sure words of both names, so one pair of them, the two rarest, finds every match; the other
    name offers all its pairs. Lists of more than ``MANY`` words are compared by single words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Align(1, known)
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                out: list[list] = [[], [], [], []]

                def put(kind: str, h: int, x: str, y: str) -> None:
                    for c, v in zip(out, (kind, h, x, y)):
                        c.append(v)

                for h, spell, cs in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    words = spell.split(" ")
                    n = dict(zip(words, cs))
                    core = align.core(words)
                    sure = sorted(sure_words(align, words), key=lambda w: (n[w], w))
                    entries = _entries(words, core)
                    if len(core) <= 2 * MANY:
                        for i, j, x in entries:
                            if not x.startswith("\t"):
                                for k, m, y in entries:
                                    if j < k or m < i:
                                        put("offer", h, x, y)
                    if len(sure) > 1 and len(core) <= MANY:
                        put("ask", h, sure[0], sure[1])
                    else:
                        for w in sure[:1] or dict.fromkeys(core or words):
                            put("ask one", h, w, "")
                    if len(sure) < 2 or len(core) > MANY // 2:
                        for _, _, x in entries or [(0, 0, w) for w in words]:
                            put("offer one", h, x, "")
                    else:
                        for i, j, x in entries:
                            if i < j:
                                put("offer one", h, x, "")
                yield _batch(out, "kind h x y", "slss")

    return run


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, word) sorted by shard -> (word, near) within one edit, both ways, one shard's trie at a time."""
    out: list[list] = [[], []]
    shard, trie = None, {}
    for batch in batches:
        for s, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if s != shard:
                shard, trie = s, {}
            # Each word meets those before it, so every pair of the shard is seen once.
            for v in within(trie, w, 1) if trie else ():
                out[0] += (w, v)
                out[1] += (v, w)
            _insert(trie, w)
        if len(out[0]) > 100_000:
            yield _batch(out, "word near", "ss")
            out = [[], []]
    yield _batch(out, "word near", "ss")


def _alike(known: frozenset[str]):
    """Rows (a, b, n_a, n_b) of near words -> those that can stand for each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Align(1, known)
        for batch in batches:
            keep = []
            for a, b, m, n in zip(*(batch.column(k).to_pylist() for k in range(4))):
                align.counts = {a: m, b: n}
                keep.append(align.same(a, b, 1) is not None)
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return run


def _meet(known: frozenset[str]):
    """Rows (shard, asks, text, n, key, most), sorted, a shard's offers before what asks -> (key asking, key offered).

    The offered partners of one anchor are a trie; each asking word walks it with its automaton. ``most`` is the
    number of edits the word may have, -1 for a form that is taken as it stands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Align(1, known)
        shard, trie, offers = None, {}, {}
        out: list[list] = [[], []]

        def hit(mine: int, theirs: list[tuple[int, int]]) -> None:
            for key, _ in theirs:
                out[0].append(mine)
                out[1].append(key)

        for batch in batches:
            for s, asks, text, n, key, most in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if s != shard:
                    shard, trie, offers = s, {}, {}
                if not asks:
                    offers.setdefault(text, []).append((key, n))
                    if text[:1] not in "\t#^":
                        _insert(trie, text)
                    continue
                if most < 0:
                    hit(key, offers.get(text, ()))
                    continue
                forms = set(_marks(text))
                if text in known:
                    forms.add(f"^{text[0]}")
                forms |= {u for i in range(1, len(text)) if (u := f"\t{text[:i]}") in offers}
                k = 0 if len(text) < 4 else 1 if most < 2 or len(text) < 6 or text in known else 2
                near = set(within(trie, text, k)) if k else set()
                for m in _rn(text) if k else ():
                    near |= set(within(trie, m, k - 1))
                for u in near - forms:
                    align.counts = {text: n, u: offers[u][0][1]}
                    if align.same(text, u, most) is not None or any(u == v for v in _rn(text)) or "m" in u and "rn" in text + u:
                        forms.add(u)
                for u in forms:
                    hit(key, offers.get(u, ()))
            if len(out[0]) > 100_000:
                yield _batch(out, "mine theirs", "ll")
                out = [[], []]
        yield _batch(out, "mine theirs", "ll")

    return run


def _halves(c: Column) -> Column:
    """Shards of a word: one edit leaves the first or the last half of the shorter word intact."""
    n = F.length(c)
    out = [F.concat(F.lit(side), F.left(c, half) if side == "<" else F.right(c, half)) for half in (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")) for side in "<>"]
    return F.array_distinct(F.array(*out))


def established_words(lists: DataFrame, counts: DataFrame, share: float, least: int, partners: int) -> list[str]:
    """The words that stand on their own: in at least this share of all lists, beside that many partners.

    A share of the lists means the same at every size, and holds the result to (words a list) / share words. Partners
    are counted by their effective number (square of the sum over sum of squares), which an entity with many
    spellings does not raise.
    """
    total = lists.count()
    most = max(least, share * total)
    common = counts.filter(F.col("n") >= most).filter(F.length("word") > 1).select("word")
    ignored = F.array(*[F.lit(w) for w in sorted(LEGAL | FILLERS)])
    core = lists.select("h", F.array_distinct(F.filter("ws", lambda w: ~F.array_contains(ignored, w))).alias("core"))
    held = core.select("h", "core", F.explode("core").alias("word")).join(common, "word")
    # A very long list is one list all the same: its words are each other's partners once.
    beside = held.select("word", F.explode("core").alias("other")).filter("word <> other").groupBy("word", "other").agg(F.count(F.lit(1)).alias("c"))
    effective = beside.groupBy("word").agg((F.pow(F.sum("c"), F.lit(2)) / F.sum(F.col("c") * F.col("c"))).alias("e"))
    legal = counts.filter(F.col("word").isin(sorted(LEGAL | FILLERS))).filter(F.col("n") >= most).select("word")
    return sorted(r[0] for r in effective.filter(F.col("e") >= partners).select("word").unionByName(legal).collect())


def candidate_pairs(lists: DataFrame, counts: DataFrame, established: int | frozenset[str], block: int = BLOCK) -> DataFrame:
    """(ha, hb), ha < hb: all pairs of ``lists(h, spell, ws)`` that ``Align.match`` may accept.

    The two rarest sure words of a name are looked up in the names of the other side: one of them is the anchor (as it
    stands, as a nickname, initial or short form, or within one edit), and the partners of each anchor form a trie
    that the other word walks. An anchor with more than ``block`` partners is split, and so is what asks for it.
    """
    spark = lists.sparkSession
    known = established if isinstance(established, frozenset) else frozenset(r[0] for r in counts.filter(F.col("n") >= established).select("word").collect())
    numbers = lists.select("h", "spell", F.posexplode("ws").alias("at", "word")).join(counts, "word").groupBy("h", "spell").agg(F.array_sort(F.collect_list(F.struct("at", F.col("n").cast("int").alias("n")))).alias("m"))
    keys = cut(numbers.select("h", "spell", F.col("m.n").alias("cs")).mapInArrow(_keys(known), "kind string, h long, x string, y string"))

    def of(kind: str) -> DataFrame:
        return keys.filter(F.col("kind") == kind)

    number = counts.select("word", F.col("n").cast("int").alias("n"))
    # Words within one edit of each other, by tries of the words that share a half.
    single = of("offer one").select(F.col("x").alias("word")).unionByName(counts.select("word")).distinct()
    words = single.filter("length(word) >= 4 and not word rlike '^[0-9\\t#^]'")
    with_rn = words.select("word", F.explode(F.when(F.col("word").contains("rn"), F.array("word", F.regexp_replace("word", "rn", "m"))).otherwise(F.array("word"))).alias("form"))
    shards = with_rn.select("form").distinct().select(F.explode(_halves(F.col("form"))).alias("shard"), F.col("form").alias("word"))
    near = cut(shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(_near_words, "word string, near string").distinct())
    same_form = with_rn.filter("word <> form").select("word", F.col("form").alias("near")).distinct()
    back = with_rn.filter("word <> form").select(F.col("form").alias("word"), F.col("word").alias("near"))
    near = near.unionByName(same_form).unionByName(back).unionByName(near.join(back.select(F.col("word").alias("near"), F.col("near").alias("o")), "near").select("word", F.col("o").alias("near"))).distinct()
    one = F.coalesce("n", F.lit(1))
    rated = near.join(number.withColumnRenamed("n", "m"), "word").join(number.withColumnRenamed("word", "near"), "near", "left").select("word", "near", "m", one.alias("n"))
    near = cut(rated.mapInArrow(_alike(known), "word string, near string"))
    # Short forms: the letters of an established word with the same first one, as many edits as letters left out.
    lexicon = spark.createDataFrame([(w,) for w in sorted(known - LEGAL - FILLERS)], "long_word string")
    short = number.join(F.broadcast(lexicon), F.expr("left(word, 1) = left(long_word, 1) and length(word) between 2 and length(long_word) - 1 and (length(word) >= 3 and startswith(long_word, word) or length(word) <= 0.7 * length(long_word) + 1 and (right(word, 1) = right(long_word, 1) or length(word) >= 4) and levenshtein(word, long_word) = length(long_word) - length(word))")).select("word", F.col("long_word").alias("alt"))
    fixed = spark.createDataFrame(sorted(SHORT_FORMS.items()), "word string, alt string")
    short = short.unionByName(fixed)
    short = cut(short.unionByName(short.select(F.col("alt").alias("word"), F.col("word").alias("alt"))).distinct())
    nick = spark.createDataFrame([(w, f"#{k}") for w, ks in sorted(_NICK.items()) for k in ks], "word string, alt string")
    initial = lexicon.select(F.col("long_word").alias("word"), F.concat(F.lit("^"), F.left("long_word", F.lit(1))).alias("alt"))
    alts = short.unionByName(nick).unionByName(initial).withColumn("most", F.lit(2)).unionByName(near.select("word", F.col("near").alias("alt"), F.lit(1).alias("most")))

    # Pairs.
    asks = of("ask").select("h", "x", "y", F.xxhash64("x", "y").alias("mine"))
    pairs = asks.select("x", "y", "mine").distinct()
    turned = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"), "mine"))
    stands = turned.select(F.col("x").alias("anchor"), "y", "mine", F.lit(2).alias("most"))
    other = turned.join(alts.withColumnRenamed("word", "x"), "x").select(F.col("alt").alias("anchor"), "y", "mine", "most")
    wanted = stands.unionByName(other)
    shorter = wanted.filter("most = 2").join(short.withColumnRenamed("word", "y"), "y").select("anchor", F.col("alt").alias("y"), "mine", F.lit(-1).alias("most"))
    wanted = cut(wanted.unionByName(shorter).join(number.withColumnRenamed("word", "y"), "y", "left").select("anchor", "y", one.alias("n"), "mine", "most"))
    offers = of("offer").select("h", F.col("x").alias("anchor"), "y", F.xxhash64("x", "y").alias("theirs"))
    offered = offers.select("anchor", "y", "theirs").distinct().join(wanted.select("anchor").distinct(), "anchor", "left_semi")
    offered = cut(offered.join(number.withColumnRenamed("word", "y"), "y", "left").select("anchor", "y", one.alias("n"), "theirs"))
    sizes = offered.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).join(wanted.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / (10 * block)).cast("int").alias("parts")), "anchor")

    def shard(df: DataFrame, mine: str, size: str, others: str) -> DataFrame:
        """Each row in its own block (or part) and in all parts (or blocks) of the other side."""
        own = F.pmod(F.xxhash64("y"), F.col(size)).cast("int")
        spread = df.join(sizes, "anchor").withColumn("own", own).withColumn("all", F.explode(F.sequence(F.lit(0), F.col(others) - 1)))
        place = F.concat_ws("\n", "anchor", "own", "all") if mine == "offer" else F.concat_ws("\n", "anchor", "all", "own")
        return spread.withColumn("shard", place)

    left = shard(offered, "offer", "blocks", "parts").select("shard", F.lit(0).alias("asks"), F.col("y").alias("text"), "n", F.col("theirs").alias("key"), F.lit(0).alias("most"))
    right = shard(wanted, "ask", "parts", "blocks").select("shard", F.lit(1).alias("asks"), F.col("y").alias("text"), "n", F.col("mine").alias("key"), "most")
    met = left.unionByName(right).repartition("shard").sortWithinPartitions("shard", "asks").mapInArrow(_meet(known), "mine long, theirs long").distinct()
    found = met.join(asks.select("mine", F.col("h").alias("a")), "mine").join(offers.select("theirs", F.col("h").alias("b")), "theirs").select("a", "b")
    # Names with one sure word.
    ask_one, offer_one = of("ask one").select(F.col("h").alias("a"), F.col("x").alias("word")), of("offer one").select(F.col("h").alias("b"), F.col("x").alias("alt"))
    starts = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.concat(F.lit("\t"), F.substring("word", F.lit(1), i)))
    prefix = ask_one.filter("length(word) > 1").select("a", F.explode(starts).alias("alt"))
    stands_for = ask_one.join(alts.select("word", "alt").distinct(), "word").select("a", "alt").unionByName(ask_one.select("a", F.col("word").alias("alt"))).unionByName(prefix)
    found = found.unionByName(stands_for.distinct().join(offer_one, "alt").select("a", "b"))
    return found.filter("a <> b").select(F.least("a", "b").alias("ha"), F.greatest("a", "b").alias("hb")).distinct()


def _checked(known: frozenset[str], contradiction: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Align(1, known)
        for batch in batches:
            keep = []
            for a, b, ca, cb in zip(*(batch.column(k).to_pylist() for k in range(2, 6))):
                a, b = a.split(" "), b.split(" ")
                align.counts = dict(zip(a + b, ca + cb))
                keep.append(not align.contradict(a, b) if contradiction else align.match(a, b))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return run


def variant_pairs(df: DataFrame, id_col: str = "internal_id", name_col: str = "name", share: float = SHARE, least: int = LEAST, partners: int = PARTNERS) -> DataFrame:
    """(id_a, id_b), id_a < id_b: records whose names mean one person or organisation.

    An id delivered twice counts once (with all its names); null names and names without a letter or digit
    have no variants. Established words are those of ``established_words`` over distinct word lists of all records.
    """
    fold = NativeFold(lookalike_table(df.sparkSession))
    from amalgrid.llm.lookalikes import python_column

    # Garbled names are compared as they were meant.
    restored = garbled_records(df.select(F.col(id_col).alias("id"), F.col(name_col).alias("name")), "id", "name")
    known_names = distinct_records(df, id_col, name_col).join(restored, ["id", "name"], "left").select("id", F.coalesce("restored", "name").alias("name"))
    rows = python_column(known_names, lambda s: " ".join(name_words(s, fold)), "name", "spell").filter("spell <> ''").select("id", "spell").distinct()
    rows = cut(rows)
    parts = F.split("spell", " ")
    # One number per distinct word list; copies, however many, count once from here on.
    lists = cut(rows.select("spell").distinct().withColumn("h", F.xxhash64("spell")).withColumn("ws", parts))
    counts = lists.select(F.explode(F.array_distinct("ws")).alias("word"), F.array_sort("ws").alias("k")).distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = cut(counts)
    known = frozenset(established_words(lists, counts, share, least, partners))
    candidates = candidate_pairs(lists, counts, known)
    numbers = lists.select("h", "spell", F.explode(F.array_distinct("ws")).alias("word")).join(counts, "word").groupBy("h", "spell").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("m"))
    texts = cut(numbers.select("h", "spell", F.transform(parts, lambda w: F.col("m")[w].cast("int")).alias("cs")))

    def with_texts(p: DataFrame) -> DataFrame:
        return p.join(texts.select(F.col("h").alias("ha"), F.col("spell").alias("sa"), F.col("cs").alias("ca")), "ha").join(texts.select(F.col("h").alias("hb"), F.col("spell").alias("sb"), F.col("cs").alias("cb")), "hb").select("ha", "hb", "sa", "sb", "ca", "cb")

    links = cut(with_texts(candidates).mapInArrow(_checked(known, False), "ha long, hb long"))
    groups = connected(links.select(F.col("ha").alias("a"), F.col("hb").alias("b")))
    inside = groups.alias("x").join(groups.alias("y"), F.expr("x.root = y.root and x.node < y.node")).select(F.col("x.node").alias("ha"), F.col("y.node").alias("hb"))
    far = inside.join(links, ["ha", "hb"], "left_anti")
    good = links.unionByName(with_texts(far).mapInArrow(_checked(known, True), "ha long, hb long"))
    spelled = rows.select("id", F.xxhash64("spell").alias("h"))
    x, y = spelled.select(F.col("h").alias("ha"), F.col("id").alias("x")), spelled.select(F.col("h").alias("hb"), F.col("id").alias("y"))
    across = good.join(x, "ha").join(y, "hb").select("x", "y")
    equal = spelled.alias("p").join(spelled.alias("q"), F.expr("p.h = q.h and p.id < q.id")).select(F.col("p.id").alias("x"), F.col("q.id").alias("y"))
    return across.unionByName(equal).filter("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()
