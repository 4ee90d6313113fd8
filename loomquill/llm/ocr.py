"""Repair of text from scanned pages: broken words, misread characters, running headers and page numbers.

One survey of the corpus counts words, neighbouring words, odd tokens and, per source, lines that recur on its pages. Words that
occur LEAST_COUNT times form the vocabulary. Every distinct token is looked up in it once: a trie of the vocabulary is walked
with the bit-parallel states of the token's Levenshtein automaton, which gives all words within one to three edits. The
vocabulary is cut into shards of SHARD words by hash, one trie each, so its size isn't bounded by anything's memory, and the
tokens are spread over the cluster. Candidates must be explained by one or two optical confusions; what a confusion costs is
learnt from the tokens that only one word and one confusion explain. What is found goes back to the texts by joins: each text
gets the facts about its own odd and rare tokens. There, candidates are ranked by frequency, cost and the words beside the
token; page furniture is dropped, and lines are joined to paragraphs.

Defined results: null and empty texts have no defects and stay as they are; rows without a key are ignored; a page counts as scanned if its source has
pages with hard line breaks; a running line must recur on SHARE of its source's pages, and on three at least (on two where the
source has up to five; on a source with one or two pages, it must be set apart at its start or end); pages without a source
form none; a word is never changed into one that the corpus doesn't have; a second confusion counts only in words of six
letters or more that aren't in the vocabulary; rows repeated under one key are one record; texts of any length are read whole.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomquill.session import cut

LEAST_COUNT, RATIO, SHARE = 3, 50, 0.08
#: Words of the vocabulary in one trie (some 30 MB), and frequent words without candidates that texts needn't ask about.
SHARD, PLAIN = 500_000, 50_000
#: What a printed character or pair may be read as, in lower case.
CONFUSIONS = {
    "i": "! 1 l | j", "l": "1 i | !", "e": "c o", "c": "e o", "o": "0 c", "s": "5 $", "b": "6 8 h", "h": "b", "a": "@ 4", "t": "f +", "f": "t", "g": "q 9", "q": "g 9",
    "z": "2", "n": "ri u", "u": "ii n", "m": "rn nn", "w": "vv", "d": "cl", "rn": "m", "ri": "n", "cl": "d", "vv": "w", "ii": "u", "nn": "m", "in": "m", "v": "y", "y": "v", "k": "lc",
}
PAIRS = tuple((right, seen) for right, all_seen in CONFUSIONS.items() for seen in all_seen.split())
BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _a, _b in PAIRS:
    BY_FIRST.setdefault(_a[0], []).append((_a, _b))
HYPHENS = "-¬­‐‑"
#: What follows a word broken at a line end: the hyphen, the break and the word's second part.
BREAK = regex.compile(rf"[{HYPHENS}][ \t]?\r?\n[ \t]*(?P<b>[\p{{L}}\p{{N}}@!|][\p{{L}}\p{{N}}@!|-]*)")
PART, LETTER = regex.compile(r"[\p{L}\p{N}@!|-]"), regex.compile(r"\p{L}")
TOKEN = regex.compile(r"[^\s.,;:()\[\]{}\"“”«»?<>/\\=*_`~^#&%+•–—·]+")
CODE = regex.compile(r"[A-Z]{1,4}-?\d[\dA-Z]*$|[\d.,-]+$|\d+[a-z]{1,3}$")
WORD = regex.compile(r"\p{L}+(?:-\p{L}+)*$")
PAGE = regex.compile(r"[-–—|\[(.·*~=<]*\s*(?:(?:page|pag|pg|p|seite|sheet|folio)\.?\s*)?(?:\d{1,4}|[ivxlc]{1,8})(?:\s*(?:of|/|von|de|sur)\s*\d{1,4})?\s*[-–—|\]).·*~=>]*$", regex.I)
EDGE_NUMBER = regex.compile(r"^(?:[-–|\[(]?\s*\d{1,4}\s*[-–|\])]?\s+)|(?:\s+[-–|\[(]?\s*\d{1,4}\s*[-–|\])]?)$")
#: Characters that are taken for each other folded together, to compare whole lines: strokes are l, whatever their number.
FOLD = str.maketrans(
    {"0": "o", "c": "o", "e": "o", "@": "a", "4": "a", "1": "l", "i": "l", "!": "l", "|": "l", "r": "l", "n": "l", "u": "l", "m": "l", "5": "s", "$": "s", "6": "b", "h": "b", "8": "b"}
    | {"f": "t", "+": "t", "9": "g", "q": "g", "y": "v", "2": "z", "d": "ol", "k": "lo", "w": "vv"}
)
STROKES = regex.compile("l+")


@lru_cache(maxsize=None)
def rx(pattern: str) -> regex.Pattern:
    """A compiled pattern; the library's own cache takes longer than most of the matches here."""
    return regex.compile(pattern)


def squeeze(line: str) -> str:
    return " ".join(line.split())


def line_key(line: str) -> str:
    """A line without page number, case and differences that misreading may make."""
    plain = EDGE_NUMBER.sub("", squeeze(line)).lower()
    return STROKES.sub("l", plain.translate(FOLD))


def wrapped(text: str) -> bool:
    """Whether a text has hard line breaks: at least two lines in a row that are no table rows or markup."""
    run = 0
    for line in text.splitlines():
        s = line.strip()
        run = run + 1 if s and len(s) < 110 and s[0] not in "|{<\\#=`-*+" and " " in s else 0
        if run >= 3:
            return True
    return bool(broken(text))


def broken(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, first part, second part) of the words broken at line ends."""
    found = []
    for m in BREAK.finditer(text):
        start = m.start()
        while start > 0 and PART.match(text[start - 1]):
            start -= 1
        if start < m.start() and text[start] != "-":
            found.append((start, m.end(), text[start : m.start()], m.group("b")))
    return found


def unbroken(text: str, found: list[tuple[int, int, str, str]]) -> str:
    """The text with a blank in the place of each broken word."""
    out, at = [], 0
    for start, end, _, _ in found:
        out += [text[at:start], " "]
        at = end
    return "".join([*out, text[at:]])


def is_page_number(line: str) -> bool:
    s = line.strip()
    return bool(s) and bool(PAGE.fullmatch(s)) and any(c.isalnum() for c in s)


def could_run(line: str) -> bool:
    """Whether a line may be a running header: some words, no table row, no sentence end."""
    s = squeeze(line)
    return 2 <= len(s.split()) <= 14 and len(s) <= 120 and s[0] not in "|{<#=\\*>" and s[-1] not in ".?!,;:-¬­‐" and any(c.isalpha() for c in s)


def tokens(text: str) -> list[str]:
    return [t for t in TOKEN.findall(text) if LETTER.search(t)]


def suspect(token: str) -> str | None:
    """A token in lower case if it may be a misread word."""
    if CODE.match(token):
        return None
    seen = token.lower()
    letters = sum(c.isalpha() for c in seen)
    if letters < 2 or letters * 2 < len(seen):
        return None
    if "-" in seen and not WORD.match(seen) and rx(r"-\d|\d-").search(seen) and rx(r"[A-Za-z]{1,3}-").match(token):
        return None
    return seen


def bare(seen: str) -> str:
    return seen.strip("'’!|-")


def is_word(a: str, b: str) -> bool:
    """Whether the two parts of what is broken at a line end make a word rather than a code."""
    return not (rx(r"[A-Z]{1,3}").fullmatch(a) and b[0].isdigit()) and bool(LETTER.search(a) and LETTER.search(b))


def forms(a: str, b: str) -> tuple[str, ...]:
    """All that is asked about a broken word: in one, with its hyphen, and its last and second part."""
    return (a + b).lower(), f"{a}-{b}".lower(), a.lower().rpartition("-")[2], b.lower()


class Survey:
    """Counts of a batch: ('word', word), ('odd', token that isn't one), ('form', of a broken word), ('pair', two words),
    ('line', key of the line with its source) and ('page', source)."""

    def __call__(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, str] = {}  # a token as a word in lower case, or ''
        for f in frames:
            words: Counter[str] = Counter()
            odd: Counter[str] = Counter()
            pairs: Counter[tuple[str, str]] = Counter()
            parts: set[str] = set()
            rows: list[tuple] = []
            if len(known) > 500_000:
                known = {}
            for key, source, text in zip(f["key"], f["source"], f["text"], strict=True):
                if not text:
                    continue
                cuts = broken(text)
                own = tokens(unbroken(text, cuts))
                for t in set(own).difference(known):
                    known[t] = t.lower() if WORD.match(t) else ""
                found = [known[t] for t in own]
                words.update(found)
                odd.update(t for t in own if not known[t])
                pairs.update(zip(found, found[1:], strict=False))
                parts.update(x for _, _, a, b in cuts if is_word(a, b) for x in forms(a, b) if x)
                if source is None:
                    continue
                hard = wrapped(text)
                rows.append(("page", source, "", key, int(hard)))
                if hard:
                    rows += [("line", source, k, key, 1) for k in {line_key(x) for x in text.splitlines() if x.strip() and could_run(x)} if k]
            rows += [("word", w, "", None, n) for w, n in words.items() if w] + [("pair", f"{a} {b}", "", None, n) for (a, b), n in pairs.items() if a and b]
            rows += [("odd", seen, "", None, n) for t, n in odd.items() if (seen := suspect(t)) is not None] + [("form", w, "", None, 0) for w in parts]
            yield pd.DataFrame(rows, columns=["kind", "a", "b", "key", "n"])


def survey(pages: DataFrame) -> DataFrame:
    """(kind, a, b, n, items) over (key, source, text), combined on the map side."""
    counted = pages.select("key", "source", "text").where(F.col("key").isNotNull() & F.col("text").isNotNull()).mapInPandas(Survey(), "kind string, a string, b string, key long, n long")
    # one row per item before the items are counted, as a page may come twice
    once = counted.groupBy("kind", "a", "b", "key").agg(F.sum("n").alias("n"))
    return cut(once.groupBy("kind", "a", "b").agg(F.sum("n").alias("n"), F.count("key").alias("items")))


def running_lines(counts: DataFrame, share: float = SHARE) -> DataFrame:
    """(source, n_pages, lines): of sources with scanned pages, the keys of the lines that recur on ``share`` of them."""
    sources = counts.where("kind = 'page'").select(F.col("a").alias("source"), F.col("items").alias("n_pages"), (F.col("n") > 0).alias("scanned")).where("scanned")
    lines = counts.where("kind = 'line'").select(F.col("a").alias("source"), F.col("b").alias("line"), "items").where("items > 1")
    often = lines.join(sources, "source").where((F.col("items") >= share * F.col("n_pages")) & ((F.col("items") >= 3) | (F.col("n_pages") <= 5)))
    # a page has some hundred lines, so at share a source keeps some hundreds of keys at most
    kept = often.groupBy("source").agg(F.collect_set("line").alias("lines"))
    return sources.join(kept, "source", "left").select("source", "n_pages", F.coalesce("lines", F.array().cast("array<string>")).alias("lines"))


class Trie:
    """Words with their counts as a packed trie: nodes are numbers, the children of one lie side by side, and each knows the
    largest count below it."""

    def __init__(self, words: dict[str, int]):
        names = sorted(words)
        self.first, self.many, self.count, self.best = (array("i", [0]) for _ in range(4))
        letters = [""]
        self.longest = max(map(len, names), default=0)
        level = [(0, 0, len(names))]  # node, and the words below it
        depth = 0
        while level:
            below = []
            for node, low, high in level:
                if low < high and len(names[low]) == depth:
                    self.count[node] = words[names[low]]
                    low += 1
                self.first[node] = len(letters)
                while low < high:
                    c, end = names[low][depth], low + 1
                    while end < high and names[end][depth] == c:
                        end += 1
                    below.append((len(letters), low, end))
                    letters.append(c)
                    for x in (self.first, self.many, self.count, self.best):
                        x.append(0)
                    self.many[node] += 1
                    low = end
            level, depth = below, depth + 1
        self.letters = "".join(["\0", *letters[1:]])
        for node in range(len(letters) - 1, -1, -1):  # children come after their parents
            self.best[node] = max([self.count[node], *(self.best[k] for k in range(self.first[node], self.first[node] + self.many[node]))])

    def within(self, word: str, edits: int, least: int = 1) -> list[tuple[str, int]]:
        """All words at most ``edits`` insertions, deletions and substitutions away that occur ``least`` times, with counts.

        Bit i of state j: the first i characters of the word are matched with at most j edits.
        """
        end = 1 << len(word)
        masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(word):
            masks[c] |= 1 << i
        full = (end << 1) - 1
        found: list[tuple[str, int]] = []
        letters, first, many, count, best = self.letters, self.first, self.many, self.count, self.best
        states = tuple((1 << (j + 1)) - 1 for j in range(edits + 1))
        if states[-1] & end and count[0] >= least:
            found.append(("", count[0]))
        stack = [(0, "", states)]
        while stack:
            node, so_far, states = stack.pop()
            for k in range(first[node], first[node] + many[node]):
                if best[k] < least:
                    continue
                mask = masks.get(letters[k], 0)
                new = [((states[0] & mask) << 1) & full]
                for j in range(1, edits + 1):
                    new.append((((states[j] & mask) << 1) | states[j - 1] | (states[j - 1] << 1) | (new[j - 1] << 1)) & full)
                if new[-1]:
                    if count[k] >= least and new[-1] & end:
                        found.append((so_far + letters[k], count[k]))
                    if many[k]:
                        stack.append((k, so_far + letters[k], tuple(new)))
        return found


def explained(seen: str, right: str, most: int = 1) -> list[str] | None:
    """The fewest confusions, ``most`` at most, that turn ``right`` into ``seen``, as 'right>seen'; None if there are none."""
    open_: list[tuple[int, int, tuple[str, ...]]] = [(0, 0, ())]
    for used in range(most + 1):
        wider, reached = [], set()
        for i, j, ops in open_:
            while True:  # along equal characters, with a confusion tried at each place
                if i == len(right) and j == len(seen):
                    return list(ops)
                if used < most:
                    for a, b in BY_FIRST.get(right[i : i + 1], ()):
                        if right.startswith(a, i) and seen.startswith(b, j) and (i + len(a), j + len(b)) not in reached:
                            reached.add((i + len(a), j + len(b)))
                            wider.append((i + len(a), j + len(b), (*ops, f"{a}>{b}")))
                if i < len(right) and j < len(seen) and right[i] == seen[j]:
                    i, j = i + 1, j + 1
                else:
                    break
        open_ = wider
    return None


class Lookup:
    """(seen, n, candidates) of the tokens (seen, n, counted) that a shard of the vocabulary has candidates for."""

    def __init__(self, shared):
        self.shared = shared

    def __call__(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = self.shared.value
        for f in frames:
            out = []
            for seen, n, known in zip(f["seen"], f["n"], f["known"], strict=True):
                size = len(seen)
                if size < 2 or size > trie.longest + 3:
                    continue
                least = LEAST_COUNT if not WORD.match(seen) else max(LEAST_COUNT, RATIO * known + 1)
                if trie.best[0] < least:
                    continue
                most = 2 if size >= 6 and not known else 1
                edits = 3 if most == 2 else 2 if rx(r"rn|vv|ii|cl|ri|nn|lc|m|n|d|w|u").search(seen) else 1
                found = [{"word": w, "n": c, "ops": ops} for w, c in trie.within(seen, edits, least) if w != seen and (ops := explained(seen, w, most))]
                if found:
                    out.append((seen, n, found))
            yield pd.DataFrame(out, columns=["seen", "n", "found"])


CANDIDATES = "array<struct<word:string,n:long,ops:array<string>>>"


def corrections(counts: DataFrame) -> DataFrame:
    """(seen, cands array of <word, n, cost>): the candidates of each token that has any. Candidates with one confusion come
    before those with two, which count only if both confusions have been seen alone."""
    context = counts.sparkSession.sparkContext
    known = F.sum(F.when((F.col("kind") == "word") & (F.col("n") >= LEAST_COUNT), F.col("n")).otherwise(0)).alias("known")
    asked = counts.where("kind in ('word', 'odd', 'form')").groupBy(F.col("a").alias("seen")).agg(F.sum("n").alias("n"), known)
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = cut(asked.repartition(tasks, "seen"))  # few bytes, but each a walk through the trie
    words = counts.where((F.col("kind") == "word") & (F.col("n") >= LEAST_COUNT)).select("a", "n")
    shards = -(-words.count() // SHARD)
    parts = []
    for k in range(shards):  # a shard at a time is at the driver
        rows = words.where(F.pmod(F.xxhash64("a"), F.lit(shards)) == k).collect()
        parts.append(asked.mapInPandas(Lookup(context.broadcast(Trie({x["a"]: x["n"] for x in rows}))), f"seen string, n long, found {CANDIDATES}"))
    if not parts:
        return counts.sparkSession.createDataFrame([], "seen string, cands array<struct<word:string,n:long,cost:double>>")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    found = cut(found.groupBy("seen").agg(F.first("n").alias("n"), F.flatten(F.collect_list("found")).alias("found")))
    # learnt from what one word explains by one confusion; there are as many rows as confusions
    single = found.where((F.size("found") == 1) & (F.size(F.col("found")[0]["ops"]) == 1))
    often = {r["op"]: r["n"] for r in single.groupBy(F.col("found")[0]["ops"][0].alias("op")).agg(F.sum(F.greatest("n", F.lit(1))).alias("n")).collect()}
    total = sum(often.values()) + len(PAIRS)
    cost = {f"{a}>{b}": -math.log((often.get(f"{a}>{b}", 0) + 1) / total) for a, b in PAIRS}
    costs = F.create_map(*[x for op, c in sorted(cost.items()) for x in (F.lit(op), F.lit(c))])
    alone = F.array(*[F.lit(op) for op in sorted(often)]).cast("array<string>")
    fewest = F.array_min(F.transform("found", lambda c: F.size(c["ops"])))
    kept = F.filter("found", lambda c: (F.size(c["ops"]) == fewest) & ((fewest == 1) | F.forall(c["ops"], lambda op: F.array_contains(alone, op))))
    summed = F.transform(kept, lambda c: F.struct(c["word"].alias("word"), c["n"].alias("n"), F.aggregate(c["ops"], F.lit(0.0), lambda t, op: t + F.element_at(costs, op)).alias("cost")))
    return found.select("seen", summed.alias("cands")).where(F.size("cands") > 0)


class Repair:
    """Finds and mends the defects of a text by what is known of its tokens: (count, candidates <word, n, cost>) of each, and
    counts of neighbouring words."""

    def __init__(self, facts: dict[str, tuple[int, list[tuple[str, int, float]]]], pairs: dict[str, int]):
        self.facts, self.pairs = facts, pairs

    def count(self, word: str) -> int:
        return self.facts.get(word, (0, ()))[0]

    def best(self, seen: str, before: str = "", after: str = "") -> str | None:
        """The candidate of highest frequency, weighed with its confusions and the words beside it."""
        found = self.facts.get(seen, (0, ()))[1]
        if len(found) < 2:
            return found[0][0] if found else None
        return max(found, key=lambda c: (math.log(c[1]) - c[2] + 2 * math.log1p(self.pairs.get(f"{before} {c[0]}", 0)) + 2 * math.log1p(self.pairs.get(f"{c[0]} {after}", 0)), c[0]))[0]

    def misread(self, token: str, before: str = "", after: str = "") -> str | None:
        """The right word if a token is misread."""
        if token.lower() not in self.facts:
            return None
        seen = suspect(token)
        if seen is None or bare(seen) != seen and self.count(bare(seen)):
            return None
        return self.best(seen, before, after)

    def whole(self, a: str, b: str) -> tuple[str, bool]:
        """The word broken into ``a`` and ``b``, and whether it was misread too."""
        joined, linked, tail, second = forms(a, b)
        n, m = self.count(joined), self.count(linked)
        if n or m:
            word = joined if n >= m else linked
            right = self.best(word)
            return right or word, right is not None
        for w in (joined, linked):
            if right := self.best(w):
                return right, True
        return (linked if self.count(tail) and self.count(second) and len(b) > 3 else joined), False

    def read(self, text: str, scanned: bool, lines: frozenset[str], n_pages: int) -> tuple[list[tuple[str, str]], str]:
        """The defects (kind, piece) of a text, and the text without them in paragraphs."""
        defects: list[tuple[str, str]] = []
        rows = text.splitlines()
        filled = [i for i, x in enumerate(rows) if x.strip()]
        kept: list[str] = []
        for i, line in enumerate(rows):
            if scanned and line.strip():
                if is_page_number(line):
                    defects.append(("pageno", squeeze(line)))
                    kept += self.mend_line(line, defects, False)
                    continue
                if could_run(line) and (line_key(line) in lines or n_pages < 3 and self.apart(rows, filled, i)):
                    defects.append(("header", squeeze(line)))
                    self.mend_line(line, defects, True)
                    continue
            kept.append(line)
        body = "\n".join(kept)
        out: list[str] = []
        at = 0
        for start, end, a, b in broken(body):
            if is_word(a, b):
                word, wrong = self.whole(a, b)
                defects.append(("hyphen", word))
                if wrong:
                    defects.append(("misread", word))
                out += [body[at:start], text_case(word, a) + "\n"]
                at = end
        body = "".join([*out, body[at:]])
        found = list(TOKEN.finditer(body)) if self.facts else []
        out, at = [], 0
        for k, m in enumerate(found):
            token = m.group()
            if token.lower() not in self.facts:
                continue
            before = found[k - 1].group().lower() if k else ""
            after = found[k + 1].group().lower() if k + 1 < len(found) else ""
            right = self.misread(token, before, after)
            if right:
                defects.append(("misread", right))
                out += [body[at : m.start()], text_case(right, token)]
                at = m.end()
        out.append(body[at:])
        return defects, reflow("".join(out)) if scanned else "".join(out)

    def mend_line(self, line: str, defects: list[tuple[str, str]], header: bool) -> list[str]:
        """Misread words of a line that is dropped."""
        if header:
            found = [m.group() for m in TOKEN.finditer(line)]
            for k, token in enumerate(found):
                right = self.misread(token, found[k - 1].lower() if k else "", found[k + 1].lower() if k + 1 < len(found) else "")
                if right:
                    defects.append(("misread", right))
        return []

    @staticmethod
    def apart(rows: list[str], filled: list[int], i: int) -> bool:
        """Whether a line stands apart at the start or the end of a page of several lines: indented, or short before a blank."""
        if len(filled) < 3 or i not in (filled[0], filled[1], filled[-1], filled[-2]):
            return False
        indent = len(rows[i]) - len(rows[i].lstrip())
        others = [len(rows[k]) - len(rows[k].lstrip()) for k in filled if k != i]
        set_in = indent >= 3 and sum(x < indent for x in others) * 2 > len(others)
        title = sum(w[0].isupper() or w[0].isdigit() for w in rows[i].split()) >= 2 and len(rows[i].split()) <= 9
        alone = (i + 1 >= len(rows) or not rows[i + 1].strip()) and (i == 0 or not rows[i - 1].strip())
        return title and (set_in or alone)


def text_case(word: str, like: str) -> str:
    return word.upper() if len(like) > 1 and like.isupper() else word[:1].upper() + word[1:] if like[:1].isupper() else word


def reflow(text: str) -> str:
    """Lines joined to paragraphs; blank lines part them."""
    out: list[list[str]] = [[]]
    for line in text.splitlines():
        s = squeeze(line)
        if not s:
            out.append([])
        elif s[0] in "|{":
            out += [[s], []]
        else:
            out[-1].append(s)
    return "\n\n".join(" ".join(p) for p in out if p)


class Asked:
    """(key, token, beside) for batches of (key, text): what a text has to ask about. Tokens come with each pair of words
    they stand between, forms of broken words with none; words in ``plain`` are known to have no candidates."""

    def __init__(self, plain):
        self.plain = plain

    def __call__(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = self.plain.value
        known: dict[str, str | None] = {}  # what a token asks about, if anything
        for f in frames:
            rows: set[tuple[int, str, str]] = set()
            if len(known) > 500_000:
                known = {}
            for key, text in zip(f["key"], f["text"], strict=True):
                if not text:
                    continue
                cuts = broken(text)
                found = TOKEN.findall(unbroken(text, cuts))
                for t in set(found).difference(known):
                    known[t] = None if t.lower() in plain else suspect(t)
                for k, t in enumerate(found):
                    seen = known[t]
                    if seen is None:
                        continue
                    rows.add((key, seen, f"{found[k - 1].lower() if k else ''}\n{found[k + 1].lower() if k + 1 < len(found) else ''}"))
                    if bare(seen) != seen:
                        rows.add((key, bare(seen), ""))
                rows.update((key, x, "") for _, _, a, b in cuts if is_word(a, b) for x in forms(a, b) if x)
            yield pd.DataFrame(list(rows), columns=["key", "token", "beside"])


def known_of(pages: DataFrame, counts: DataFrame) -> DataFrame:
    """(key, facts, pairs): what each text's odd and rare tokens are, and how often their candidates stand beside their
    neighbours. Texts without such tokens have no row."""
    found = cut(corrections(counts))
    words = counts.where((F.col("kind") == "word") & (F.col("n") >= LEAST_COUNT)).select(F.col("a").alias("token"), F.col("n").alias("known"))
    facts = words.join(found.withColumnRenamed("seen", "token"), "token", "full").select("token", F.coalesce("known", F.lit(0)).alias("known"), "cands")
    plain = facts.where(F.col("cands").isNull()).orderBy(F.desc("known"), "token").limit(PLAIN).select("token")
    shared = pages.sparkSession.sparkContext.broadcast(frozenset(r["token"] for r in plain.collect()))
    asked = pages.select("key", "text").mapInPandas(Asked(shared), "key long, token string, beside string").distinct()
    told = cut(asked.join(facts, "token"))
    several = told.where((F.size("cands") > 1) & (F.col("beside") != "")).select("key", F.explode("cands").alias("c"), F.split("beside", "\n").alias("x"))
    sides = F.array(F.concat_ws(" ", F.col("x")[0], F.col("c.word")), F.concat_ws(" ", F.col("c.word"), F.col("x")[1]))
    pairs = counts.where("kind = 'pair'").select(F.col("a").alias("pair"), "n")
    near = several.select("key", F.explode(sides).alias("pair")).distinct().join(pairs, "pair")
    near = near.groupBy("key").agg(F.collect_list(F.struct("pair", "n")).alias("pairs"))
    once = told.groupBy("key", "token").agg(F.first("known").alias("known"), F.first("cands").alias("cands"))
    return once.groupBy("key").agg(F.collect_list(F.struct("token", "known", "cands")).alias("facts")).join(near, "key", "left")


class Apply:
    """(key, defects, text) for batches of (key, text, scanned, n_pages, lines, facts, pairs)."""

    def __call__(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = []
            for key, text, scanned, n_pages, lines, facts, pairs in zip(*(f[c] for c in ("key", "text", "scanned", "n_pages", "lines", "facts", "pairs")), strict=True):
                own = {x["token"]: (x["known"], [(c["word"], c["n"], c["cost"]) for c in x["cands"]] if x["cands"] is not None else []) for x in (facts if facts is not None else ())}
                repair = Repair(own, {x["pair"]: x["n"] for x in (pairs if pairs is not None else ())})
                defects, mended = repair.read(text, bool(scanned), frozenset(lines if lines is not None else ()), int(n_pages)) if text else ([], text)
                found.append((key, [{"defect": d, "piece": p} for d, p in dict.fromkeys(defects)], mended))
            yield pd.DataFrame(found, columns=["key", "defects", "text"])


def mended(pages: DataFrame) -> DataFrame:
    """(key, defects, text) of (key BIGINT, source, text): each text's defects (defect, piece) and its repaired form.

    Keys are unique over the pages, but for repeated rows.
    """
    counts = survey(pages)
    keyed = pages.select("key", "source", "text").where(F.col("key").isNotNull())
    told = known_of(keyed, counts)
    # rows without a source need no lines; one row per source is on the right, so a source with many pages can be split
    lines = running_lines(counts)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("n_pages", "bigint"), ("lines", "array<string>"))]
    sourced = keyed.where(F.col("source").isNotNull()).join(lines, "source", "left").select("key", "text", "n_pages", "lines")
    ready = sourced.unionByName(keyed.where(F.col("source").isNull()).select("key", "text", *none)).join(told, "key", "left")
    ready = ready.select("key", "text", F.col("n_pages").isNotNull().alias("scanned"), F.coalesce("n_pages", F.lit(0)).alias("n_pages"), "lines", "facts", "pairs")
    return ready.mapInPandas(Apply(), "key long, defects array<struct<defect:string,piece:string>>, text string")
