"""Language of documents and of the segments of mixed ones, by a small convolutional network over bytes.

The network embeds bytes, convolves them with filters of several widths, takes each filter's maximum over a window of
fixed length and ends in a softmax. It is trained in numpy at the time of the query on a bounded, documented sample of
labelled rows (at most SAMPLE_DOCS documents per language, SAMPLE_SENTENCES sentences of each, SAMPLE_WINDOWS windows); sentences whose label
the half-trained network contradicts are set aside as mislabelled and the network is trained again without them. The weights (about 100 kB) are broadcast;
applying them needs no shuffle. A sentence's confidence is the probability of its language by its windows together; sentences
below SURE (those of few words or ending in an ellipsis below SURE_SHORT) take the likeliest language of the document's sure ones, with its probability; neighbouring
sentences of one language form a segment with the mean of theirs. Headings and unfinished lines belong to segments too: those of
four words or more to their own language from SURE_SHORT on, others to that of the piece before or after, whichever is likelier; they
count for the confidence only where a segment has no sentence. A language exists if the sample holds LEAST_SENTENCES of its sentences or, where none
has so many, one; texts in others go to the nearest.

Defined results: null, empty and blank texts and texts without a word have no segments; a sentence ends with a mark
(. ! ? … or those of other scripts) and has at least one word; a mark before a small letter or a digit ends none of under four
words (six letters in scripts without blanks), as after abbreviations, nor does one after a single letter, nor an ellipsis; only sentences decide about labels and mixtures, and a text
whose sentences all have few words contradicts its label only if one is sure; labels are compared as ISO 639-1 codes, whatever
their spelling; rows without a key are ignored; rows repeated under one key give the same rows again; without labelled rows there are no
languages and no segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The spellings of each language label, in lower case, besides regions such as en-us.
SPELLINGS = {
    "en": "en eng english anglais englisch ingles", "de": "de deu ger german deutsch allemand", "fr": "fr fra fre french francais français französisch",
    "es": "es spa spanish espanol español castellano spanisch", "pt": "pt por portuguese portugues português", "it": "it ita italian italiano",
    "nl": "nl nld dut dutch nederlands flemish", "ru": "ru rus russian русский", "ja": "ja jpn japanese 日本語",
    "zh": "zh zho chi chinese 中文", "ko": "ko kor korean", "pl": "pl pol polish polski", "sv": "sv swe swedish svenska", "da": "da dan danish dansk",
    "no": "no nor nb nob norwegian norsk", "fi": "fi fin finnish suomi", "cs": "cs ces cze czech", "tr": "tr tur turkish", "ar": "ar ara arabic", "uk": "uk ukr ukrainian",
}
WINDOW, WIDTHS, FILTERS, EMBEDDED = 96, (2, 3, 5), 48, 12
SAMPLE_DOCS, SAMPLE_SENTENCES, SAMPLE_WINDOWS, LEAST_SENTENCES, SURE = 300, 6, 12_000, 20, 0.8
SURE_SHORT, WORDS, LETTERS = 0.95, 4, 6
CLOSERS = "\"'’”“»«›‹)]}*_`」』）】〉》"
END = regex.compile(rf"[.!?…][{regex.escape(CLOSERS)}]*+(\s+|(?=\p{{Lu}}\p{{Ll}}))|(?![.!?．])\p{{STerm}}[’”」』）】〉》]*+(\s*)|．(?!\p{{N}})[’”」』）】〉》]*+(\s*)|(\n\s*\n)")
FORMAT, DIGITS, BLANKS = regex.compile(r"\p{Cf}"), regex.compile(r"\d+"), regex.compile(r"\s+")
MARK = regex.compile(r"[\p{STerm}…]")
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]+")
PLAIN_WORD = regex.compile(r"(?<![\p{L}\p{M}\p{N}_-])\p{L}[\p{L}\p{M}]+(?![\p{L}\p{M}]|[-_]?\p{N})")  # no part of a code such as KF-25311
SMALL = regex.compile(r"[^\p{L}\p{N}]*[\p{Ll}\p{N}]")
INITIAL = regex.compile(r"(?<![\p{L}\p{N}])\p{L}\.$")
UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


def normal_label(c: Column) -> Column:
    """ISO 639-1 code of a label however spelt, or null where it names no language."""
    bare = F.regexp_extract(F.lower(F.trim(c)), r"^([\p{L}]+)(?:[-_ (].*)?$", 1)
    pairs = [x for code, names in SPELLINGS.items() for name in names.split() for x in (F.lit(name), F.lit(code))]
    return F.try_element_at(F.create_map(*pairs), bare)


def pieces(text: str | None) -> list[tuple[int, int, bool, bool]]:
    """(start, end, is it a whole sentence, has it four words or more and doesn't trail off) of everything with words in a text."""
    found: list[tuple[int, int, bool, int, int, bool]] = []
    if not text:
        return []
    at, apart = 0, True
    for start, end in [m.span(m.lastindex) for m in END.finditer(text)] + [(len(text), len(text))]:
        piece = text[at:start].strip()
        if piece:
            a = start - len(text[at:start].lstrip())
            b = a + len(piece)
            words = len(WORD.findall(piece))
            letters = 0 if words >= WORDS else len(UNSPACED.findall(piece))
            many = words >= WORDS or letters >= LETTERS
            any_word = many or letters > 0 or PLAIN_WORD.search(piece) is not None
            last = piece.rstrip(CLOSERS)[-1:]
            whole = MARK.match(last) is not None and (many or last != "…")
            short = found and whole and not apart and not (many and _many(found[-1]))
            if short and (SMALL.match(piece) or INITIAL.search(text, max(found[-1][0], found[-1][1] - 3), found[-1][1])):
                a, _, _, w, c, some = found.pop()
                words, letters, any_word = words + w, letters + c, any_word or some
            found.append((a, b, whole, words, letters, any_word))
        apart, at = text.count("\n", start, end) > 1, end
    return [(*p[:3], _many(p) and text[p[0] : p[1]].rstrip(CLOSERS)[-1:] != "…") for p in found if p[5]]


def _many(piece: tuple[int, int, bool, int, int, bool]) -> bool:
    return piece[3] >= WORDS or piece[4] >= LETTERS


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of the whole sentences of a text, however short."""
    return [(a, b) for a, b, whole, _ in pieces(text) if whole]


def window_bytes(sentence: str) -> list[bytes]:
    """Windows of WINDOW bytes that cover a sentence, without case, format characters and unlike digits and blanks."""
    plain = sentence.lower()
    plain = plain if plain.isascii() else FORMAT.sub("", plain)
    raw = BLANKS.sub(" ", DIGITS.sub("0", plain)).encode("utf-8", "surrogatepass")
    starts = [*range(0, max(1, len(raw) - WINDOW), WINDOW)]
    if len(raw) > WINDOW:
        starts.append(len(raw) - WINDOW)
    return [raw[s : s + WINDOW].ljust(WINDOW, b"\0") for s in starts]


def _array(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), dtype=np.uint8).reshape(-1, WINDOW)


class Network:
    """Byte embedding, convolutions of several widths, maximum over positions, softmax."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"e": rng.normal(0, 0.5, (256, EMBEDDED)), "w": rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))), "b": np.zeros(len(languages))}
        for w in WIDTHS:
            self.p[f"c{w}"] = rng.normal(0, (2 / (w * EMBEDDED)) ** 0.5, (w * EMBEDDED, FILTERS))
            self.p[f"d{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _maxima(self, x: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """(windows, filters): the largest value of every filter, and where it is. All widths are one matrix product: narrow
        filters have zeros behind them, and the last positions, where only they fit, are added."""
        emb, wide = self.p["e"][x], max(WIDTHS)
        n, length = x.shape
        both = np.zeros((wide * EMBEDDED, FILTERS * len(WIDTHS)), dtype=np.float32)
        for j, w in enumerate(WIDTHS):
            both[: w * EMBEDDED, j * FILTERS : (j + 1) * FILTERS] = self.p[f"c{w}"]

        def patches(e: np.ndarray, w: int) -> np.ndarray:
            return np.lib.stride_tricks.sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2).reshape(-1, w * EMBEDDED)

        z = (patches(emb, wide) @ both).reshape(n, length - wide + 1, -1)
        best, at = z.max(axis=1), None
        if places:
            at = z.argmax(axis=1)
        for j, w in enumerate(WIDTHS):
            if w < wide:
                own = slice(j * FILTERS, (j + 1) * FILTERS)
                tail = (patches(emb[:, length - wide + 1 :], w) @ self.p[f"c{w}"]).reshape(n, wide - w, FILTERS)
                if places:
                    at[:, own] = np.where(tail.max(axis=1) > best[:, own], length - wide + 1 + tail.argmax(axis=1), at[:, own])
                best[:, own] = np.maximum(best[:, own], tail.max(axis=1))
        return best + np.concatenate([self.p[f"d{w}"] for w in WIDTHS]), at

    def log_probabilities(self, x: np.ndarray, step: int = 128) -> np.ndarray:
        """(windows, languages). Windows of like length go together, and only so much of the padding as any filter sees."""
        length = WINDOW - (x[:, ::-1] != 0).argmax(axis=1)
        out = np.zeros((len(x), len(self.languages)), dtype=np.float32)
        order = np.argsort(length, kind="stable")
        for i in range(0, len(x), step):
            rows = order[i : i + step]
            part = x[rows, : min(WINDOW, int(length[rows[-1]]) + max(WIDTHS))]
            z = np.maximum(self._maxima(part)[0], 0) @ self.p["w"] + self.p["b"]
            z -= z.max(axis=1, keepdims=True)
            out[rows] = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int, rate: float = 0.004, seed: int = 1) -> None:
        """Adam on the cross entropy; only the positions of the maxima carry gradients back."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), 64):
                rows = order[i : i + 64]
                f, at = self._maxima(x[rows], places=True)
                f = np.maximum(f, 0)
                z = f @ self.p["w"] + self.p["b"]
                z = np.exp(z - z.max(axis=1, keepdims=True))
                d = z / z.sum(axis=1, keepdims=True)
                d[np.arange(len(rows)), y[rows]] -= 1
                d /= len(rows)
                g = {"w": f.T @ d, "b": d.sum(axis=0), "e": np.zeros_like(self.p["e"])}
                back = (d @ self.p["w"].T) * (f > 0)
                for j, w in enumerate(WIDTHS):
                    own = back[:, j * FILTERS : (j + 1) * FILTERS]
                    places = x[rows][np.arange(len(rows))[:, None, None], at[:, j * FILTERS : (j + 1) * FILTERS, None] + np.arange(w)]
                    chosen = self.p["e"][places].reshape(len(rows), FILTERS, w * EMBEDDED)
                    g[f"c{w}"] = np.einsum("nfk,nf->kf", chosen, own)
                    g[f"d{w}"] = own.sum(axis=0)
                    to = (own[:, :, None] * self.p[f"c{w}"].T[None]).reshape(len(rows), FILTERS, w, EMBEDDED)
                    np.add.at(g["e"], places.ravel(), to.reshape(-1, EMBEDDED))
                t += 1
                for k, v in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * v
                    s[k] = 0.999 * s[k] + 0.001 * v * v
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)


def _drawn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SAMPLE_SENTENCES sentences of each text, drawn from the whole of it."""
    for f in frames:
        rows = []
        for code, text in zip(f["code"], f["text"], strict=True):
            spans = sentences(text)
            rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
            rows += [(code, text[slice(*spans[k])]) for k in rng.permutation(len(spans))[:SAMPLE_SENTENCES]]
        yield pd.DataFrame(rows, columns=["code", "sentence"])


def train(docs: DataFrame, seed: int = 7) -> Network:
    """Fits the network on a bounded sample of (id, text, lang): the documents with the smallest hashes per language."""
    labelled = docs.select("id", "text", normal_label(F.col("lang")).alias("code")).where(F.col("code").isNotNull() & (F.length("text") > 20))
    ranked = labelled.withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy(F.xxhash64("id"), "text"))).where(F.col("n") <= SAMPLE_DOCS)
    # at most SAMPLE_DOCS texts a language and SAMPLE_SENTENCES of each come to the driver
    drawn = sorted((r["code"], r["sentence"]) for r in ranked.select("code", "text").mapInPandas(_drawn, "code string, sentence string").collect())
    count = pd.Series([code for code, _ in drawn]).value_counts()
    languages = sorted(count.index[count >= LEAST_SENTENCES]) or sorted(count.index)
    rng = np.random.default_rng(seed)
    windows: list[bytes] = []
    labels: list[int] = []
    for code, sentence in drawn:
        if code in languages:
            parts = window_bytes(sentence)
            windows += parts
            labels += [languages.index(code)] * len(parts)
    net = Network(languages, seed)
    if not windows:
        return net
    x, y = _array(windows), np.array(labels)
    share = rng.permutation(len(x))[:SAMPLE_WINDOWS]
    x, y = x[share], y[share]
    more = 64 * 250 // len(x)  # a small sample is gone through more often
    net.fit(x, y, epochs=max(2, more), rate=0.003)
    trusted = net.log_probabilities(x).argmax(axis=1) == y
    net = Network(languages, seed + 1)  # afresh: the first one has begun to learn the wrong labels too
    net.fit(x[trusted], y[trusted], epochs=max(3, more), rate=0.003)
    return net


#: n: whole sentences in the segment; firm: whether one of them has four words or more, or is sure
SEGMENTS = "array<struct<start:int,length:int,lang:string,confidence:double,n:int,firm:boolean>>"


class Classify:
    """(key, segments) for batches of (key, text): arrays of SEGMENTS."""

    def __init__(self, net):
        self.net = net

    def __call__(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = self.net.value
        known: dict[str, np.ndarray] = {}
        for whole in frames:
            for at in range(0, len(whole), 1000):
                f = whole.iloc[at : at + 1000]
                spans = [pieces(t) for t in f["text"]]
                texts = [t[a:b] for t, s in zip(f["text"], spans, strict=True) for a, b, *_ in s]
                if len(known) > 100_000:
                    known = {}
                new = [x for x in dict.fromkeys(texts) if x not in known]
                known.update(zip(new, self.decide(net, new), strict=True))
                at_text = iter(texts)
                yield pd.DataFrame({"key": f["key"].to_numpy(), "segments": [self.segments(net, s, [known[next(at_text)] for _ in s]) for s in spans]})

    @staticmethod
    def decide(net: Network, texts: list[str]) -> list[np.ndarray]:
        """The probabilities of the languages of each sentence."""
        parts = [window_bytes(t) for t in texts]
        if not parts or not net.languages:
            return [np.zeros(0)] * len(parts)
        log = net.log_probabilities(_array([w for p in parts for w in p]))
        size = np.array([len(p) for p in parts])
        mean = np.add.reduceat(log, np.cumsum(size) - size, axis=0) / np.sqrt(size)[:, None]
        mean -= mean.max(axis=1, keepdims=True)
        p = np.exp(mean)
        p /= p.sum(axis=1, keepdims=True)
        return list(p)

    @staticmethod
    def segments(net: Network, spans: list[tuple[int, int, bool, bool]], found: list[np.ndarray]) -> list[dict]:
        if not net.languages or not spans:
            return []
        sure = [bool(p.max() >= (SURE if whole and many else SURE_SHORT)) for (*_, whole, many), p in zip(spans, found, strict=True)]
        voters = [i for i, s in enumerate(spans) if s[2]] or range(len(spans))
        votes = np.zeros(len(net.languages))
        for i in voters:
            lang = int(found[i].argmax())
            votes[lang] += found[i][lang] if sure[i] else 0.01 * found[i][lang]
        certain = sorted({int(found[i].argmax()) for i in voters if sure[i]}) or [int(votes.argmax())]
        chosen = [int(p.argmax()) if s and (whole or many) else max(certain, key=lambda x: p[x]) if whole else None for (_, _, whole, many), p, s in zip(spans, found, sure, strict=True)]
        after, k = list(chosen), None
        for i in reversed(range(len(chosen))):
            after[i] = k = chosen[i] if chosen[i] is not None else k
        before = None
        out: list[dict] = []
        for (a, b, whole, many), each, lang, following, s in zip(spans, found, chosen, after, sure, strict=True):
            if lang is None:
                lang = max([x for x in (before, following) if x is not None] or certain, key=lambda x: each[x])
            before = lang
            p, code = float(each[lang]), net.languages[lang]
            if not out or out[-1]["lang"] != code:
                out.append({"start": a, "lang": code, "confidence": 0.0, "n": 0, "rest": 0, "firm": False})
            last = out[-1]
            last["length"] = b - last["start"]
            if whole:
                last["confidence"] = (last["confidence"] * last["n"] + p) / (last["n"] + 1)
                last["n"] += 1
                last["firm"] |= many or s
            elif not last["n"]:
                last["rest"] += 1
                last["confidence"] += (p - last["confidence"]) / last["rest"]
        return out


def classified(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """(key, segments) for (id, text, lang); trains the network on the same rows unless one is given."""
    net = net or train(docs)
    kind = docs.schema["id"].dataType.simpleString()
    weights = docs.sparkSession.sparkContext.broadcast(net)
    schema = f"key {kind}, segments {SEGMENTS}"
    return docs.where(F.col("id").isNotNull()).select(F.col("id").alias("key"), "text").mapInPandas(Classify(weights), schema)


def relabelled(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """(id, lang): the languages of each document whose label is missing or wrong, or whose text mixes languages."""
    net = net or train(docs)
    kind = docs.schema["id"].dataType.simpleString()
    weights = docs.sparkSession.sparkContext.broadcast(net)
    docs = docs.where(F.col("id").isNotNull())
    # the label travels in the key's place next to it, so that no join is needed
    keyed = docs.select(F.struct(F.col("id"), normal_label(F.col("lang")).alias("label")).alias("key"), "text")
    schema = f"key struct<id:{kind},label:string>, segments {SEGMENTS}"
    found = keyed.mapInPandas(Classify(weights), schema).select("key.id", "key.label", F.filter("segments", lambda s: s["n"] > 0).alias("whole"))
    found = found.select("id", "label", F.array_distinct(F.transform("whole", lambda s: s["lang"])).alias("langs"), F.exists("whole", lambda s: s["firm"]).alias("firm"))
    wrong = F.col("label").isNull() | (F.col("firm") & ~F.array_contains("langs", F.col("label"))) | (F.size("langs") > 1)
    return found.where((F.size("langs") > 0) & wrong).select("id", F.explode("langs").alias("lang")).distinct()
