"""Byte-level BPE by a pair occurrence index, and chunk-wise use of library tokenizers.

``PairIndexBPE`` encodes all new pretokens of a partition's batch at once. An index maps the rank of each pair to all its
positions; active ranks are applied in ascending order, each to all its positions from left to right, and the lists of the
pairs that appear beside a merge are updated. Encoded chunks of text are kept in a bounded cache, which changes no result.

Nulls: a null text is encoded as an empty one, without ids. Texts of any length are encoded whole. Repeated rows and rows
alike are encoded each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import accumulate, chain, compress

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices, table, with_key

#: Fixed value: the pattern of the byte-level vocabulary that cuts a text into pretokens.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Where this is found, a text cannot be cut at single spaces and line feeds without changing its pretokens.
IRREGULAR = regex.compile(r"\s\s|^\s|\s$")


#: Entries of a generation of the caches: with the keys and values of this size, 100 MB in a worker at most.
CHUNKS, PRETOKENS = 250_000, 30_000


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file of this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones are themselves, the others follow from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Recent:
    """A bounded cache in two generations: what is used again stays."""

    def __init__(self, limit: int = 300_000):
        self.limit, self.new, self.old = limit, {}, {}

    def get_distinct(self, keys: list, make: Callable[[list], list]) -> list:
        """As get_many, for keys that are distinct; make gets the unknown ones in their order."""
        new, old = self.new, self.old
        rest = [k for k in keys if k not in new]
        if rest:
            if old:
                again = {k: old[k] for k in rest if k in old}
                new.update(again)
                rest = [k for k in rest if k not in again]
            new.update(zip(rest, make(rest), strict=True))
        found = list(map(new.__getitem__, keys))
        if len(new) > self.limit:
            self.new, self.old = {}, new
        return found

    def get_many(self, keys: list, make: Callable[[list], list]) -> list:
        """Values of the keys, which may come again; make gets the distinct unknown ones and gives their values."""
        found = list(map(self.new.get, keys))
        at = [i for i, value in enumerate(found) if value is None]
        if at:
            unknown = list(dict.fromkeys([keys[i] for i in at]))
            known = dict(zip(unknown, self.get_distinct(unknown, make), strict=True))
            for i in at:
                found[i] = known[keys[i]]
        return found


class PairIndexBPE:
    """Encoder and decoder of a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids, letters = spec["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.packed_special = {token: np.array([i], "<u4").tobytes() for token, i in self.special.items()}
        self.token_bytes = [b""] * size
        for token, i in ids.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.decimal = [str(i) for i in range(size)]
        self.of_byte = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        #: pair (left id shifted by 20 bits, right id) -> rank; rank -> left, right and new id
        self.rank = {ids[a] << 20 | ids[b]: r for r, (a, b) in enumerate(merges)}
        self.merged = [(ids[a], ids[b], ids[a + b]) for a, b in merges]
        self.cut_special = regex.compile("|".join(f"({regex.escape(t)})" for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.chunks, self.pretokens = Recent(CHUNKS), Recent(PRETOKENS)

    def merge(self, pretokens: list[str]) -> list[bytes]:
        """Ids of each pretoken as unsigned 32-bit integers."""
        symbol, after, before, starts = [], [], [], []
        for text in pretokens:
            own = [self.of_byte[b] for b in text.encode("utf-8", "surrogatepass")]
            at = len(symbol)
            starts.append(at)
            symbol += own
            after += [*range(at + 1, at + len(own)), -1]
            before += [-1, *range(at, at + len(own) - 1)]
        rank, index = self.rank, defaultdict(list)
        for i, j in enumerate(after):
            if j >= 0 and (r := rank.get(symbol[i] << 20 | symbol[j])) is not None:
                index[r].append(i)
        active = list(index)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            left, right, new = self.merged[r]
            for i in sorted(index.pop(r)):
                j = after[i]
                if j < 0 or symbol[i] != left or symbol[j] != right:
                    continue  # one of the two was merged meanwhile
                symbol[i], symbol[j] = new, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    if (q := rank.get(new << 20 | symbol[k])) is not None:
                        if q not in index:
                            heapq.heappush(active, q)
                        index[q].append(i)
                h = before[i]
                if h >= 0 and (q := rank.get(symbol[h] << 20 | new)) is not None:
                    if q not in index:
                        heapq.heappush(active, q)
                    index[q].append(h)
        ids = np.array(symbol, np.int64)
        stays = ids >= 0
        packed = ids[stays].astype("<u4").tobytes()
        ends = np.concatenate([[0], np.cumsum(stays)])
        bounds = ends[[*starts, len(symbol)]] * 4
        return [packed[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """A chunk is what stands between two single spaces: it starts with the space before it, or with a line feed.

        One of letters only is one pretoken and is kept as a chunk alone; others are cut, and their words looked up among these.
        """
        whole = [c for c in chunks if c.isalpha()]
        merged = dict(zip(whole, self.merge([f" {c}" for c in whole]), strict=True))
        known = self.chunks.new
        cut = {c: PRETOKEN.findall(c if c[0] == "\n" else f" {c}") for c in chunks if c not in merged}
        parts = [p for own in cut.values() for p in own if p[0] != " " or p[1:] not in known]
        ids = dict(zip(parts, self.pretokens.get_many(parts, self.merge), strict=True))
        return [merged[c] if c in merged else b"".join([ids[p] if p in ids else known[p[1:]] for p in cut[c]]) for c in chunks]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, with those of special tokens that stand in it, as unsigned 32-bit integers."""
        listed: list[list[str]] = []
        heads: list[list[str]] = []
        for text in texts:
            if not text or IRREGULAR.search(text) or (self.cut_special and self.cut_special.search(text)):
                heads.append(self._pretokens(text))
                listed.append([])
            else:
                first, *rest = text.replace("\n", " \n").split(" ")
                heads.append(PRETOKEN.findall(first))
                listed.append(rest)
        plain = iter(self.pretokens.get_many([p for own in heads for p in own if p not in self.special], self.merge))
        flat = self.chunks.get_many([c for own in listed for c in own], self._chunks)
        out, at = [], 0
        for head, own in zip(heads, listed, strict=True):
            out.append(b"".join([self.packed_special[p] if p in self.special else next(plain) for p in head] + flat[at : at + len(own)]))
            at += len(own)
        return out

    def _pretokens(self, text: str) -> list[str]:
        """Pretokens of any text, special tokens among them as they stand."""
        parts = self.cut_special.split(text) if self.cut_special else [text]
        return [p for part in parts if part for p in ([part] if part in self.special else PRETOKEN.findall(part))]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(2)
def pair_index(path: str) -> PairIndexBPE:
    return PairIndexBPE(path)


class LibraryBPE:
    """Encoder of a vocabulary file of the tokenizers library whose pretokens never hold white space and end in tokens marked ``</w>``.

    Every chunk between ASCII spaces is encoded by the library once while it is in the cache. Words
    of letters are sent to it many at a time, as one text, and told apart by the marked tokens. Ids fit in 16 bits.
    """

    MARKS = ".,;:!?#*$%&|"
    TOGETHER = 2000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary_ = self.library.get_vocab()
        if max(vocabulary_.values()) >= 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self.last = np.zeros(1 << 16, bool)
        self.last[[i for token, i in vocabulary_.items() if token.endswith("</w>")]] = True
        self.chunks, self.words, self.marks = Recent(700_000), Recent(100_000), {}

    def _apart(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters; a word that the library cuts in two makes its group be encoded word by word."""
        out = []
        groups = [words[i : i + self.TOGETHER] for i in range(0, len(words), self.TOGETHER)]
        for group, encoding in zip(groups, self.library.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(encoding.ids, "<u2")
            ends = 2 * (np.flatnonzero(self.last[ids]) + 1)
            if len(ends) != len(group) or not len(ids) or ends[-1] != 2 * len(ids):
                out += self._apart(group)
                continue
            packed, bounds = ids.tobytes(), [0, *ends.tolist()]
            out += [packed[a:b] for a, b in zip(bounds, bounds[1:])]
        return out

    def _chunks(self, chunks: list[bytes]) -> list[bytes]:
        # letters and the marks behind them are separate pretokens: fewer words for the library
        texts = [raw.decode("utf-8", "surrogatepass") for raw in chunks]
        cores = [t.rstrip(self.MARKS) for t in texts]
        lettered = list(map(str.isalpha, cores))
        words = list(compress(cores, lettered))
        tails = [t[len(c) :] for t, c in zip(compress(texts, lettered), words)]
        of_mark = self.marks
        if fresh := [m for m in dict.fromkeys(tails) if m not in of_mark]:
            if len(of_mark) > 10_000:
                of_mark.clear()
                fresh = list(dict.fromkeys(tails))
            of_mark.update(zip(fresh, self._apart(fresh), strict=True))
        alone = iter([ids + of_mark[m] for ids, m in zip(self.words.get_many(words, self._words), tails, strict=True)])
        others = iter(self._apart([t for t, ok in zip(texts, lettered) if not ok]))
        return [next(alone) if ok else next(others) for ok in lettered]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, given in UTF-8, as unsigned 16-bit integers."""
        # the vocabulary drops case; A-Z are lowered here, but where a combining mark (lead bytes CC and CD) could compose with them
        words = [(t if b"\xcc" in t or b"\xcd" in t else t.lower()).split() for t in texts]
        ids = self.chunks.get_many(list(chain.from_iterable(words)), self._chunks)
        ends = list(accumulate(map(len, words), initial=0))
        return [b"".join(ids[a:b]) for a, b in zip(ends, ends[1:])]


@lru_cache(2)
def library(path: str) -> LibraryBPE:
    return LibraryBPE(path)


def texts_of(batch: pd.DataFrame, size: int = 2_000_000) -> Iterator[tuple[pd.DataFrame, list]]:
    """Parts of a batch of about so many characters or bytes, with their texts, null as empty."""
    texts = ["" if t is None else t for t in batch["text"]]
    for first, last in slices(texts, size):
        yield batch.iloc[first:last], texts[first:last]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (unsigned 32-bit integers) and the text decoded from them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = pair_index(path)
        for batch in batches:
            for part, texts in texts_of(batch):
                ids = bpe.encode(texts)
                yield pd.DataFrame({"doc_id": part["doc_id"], "ids": ids, "decoded": [bpe.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]})

    return with_key(docs).mapInPandas(run, "doc_id string, ids binary, decoded string").withColumn("doc_id", F.col("doc_id").cast("long"))


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; the digests are made beside the ids, so that neither ids nor texts leave the worker."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = pair_index(path)
        for batch in batches:
            for part, texts in texts_of(batch):
                rows = []
                for packed in bpe.encode(texts):
                    ids = np.frombuffer(packed, "<u4").tolist()
                    listed = ",".join(map(bpe.decimal.__getitem__, ids))
                    rows.append((len(ids), sha256(listed.encode()).hexdigest(), sha256(bpe.decode(ids).encode("utf-8", "surrogatepass")).hexdigest()))
                out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
                out.insert(0, "doc_id", part["doc_id"].to_numpy())
                yield out

    schema = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return with_key(docs).mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def op7_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return encoding_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
