"""Token counts of a public tokenizer, with overlap resynchronisation for huge documents.

A document of more than ``HUGE`` characters is encoded in chunks that overlap. A place in an overlap is a proven stable boundary if in both encodings a
piece of the splitter ends before it and another begins at it: the token before it carries the end-of-word mark that the tokenizer gives to the last token of each piece
(or is an added token), and no token's span lies across it. A piece that ends before a chunk's end ends there in the whole text too, as
nothing after its next character decides it; so from such a place on, both encodings and the library's agree, whatever the number of tokens of a character. Within ``MARGIN`` of
a chunk's ends an added token might be cut, so there only a place after white space counts, which no added token holds. The left chunk counts up to the boundary nearest to
the overlap's middle, the right one from it. If an overlap has none, it is doubled, up to the whole chunk, and then the chunks are joined; a text without any
boundary is encoded whole, as the library would. So memory is bounded by the chunk unless the text is one unbroken run.

A smaller document is counted by its pieces between blanks: where the tokenizer's normaliser turns white space into blanks and its splitter
drops them, a text has as many tokens as its pieces have together. Counts of pieces are remembered in each worker (at most
``MEMORY`` of them). Both ways rest on what the tokenizer's file says of its normaliser, splitter and added tokens, and this is checked as the file is
loaded (`drops_blanks`); with any other file every text is encoded whole.

A null text is empty and has no tokens. Repeated rows are counted each for itself. An empty table gives an empty table. Only doc_id and text are read, so
other columns can have any name.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HUGE, CHUNK, OVERLAP = 32_768, 16_384, 256
#: More than the length of any special token, which could lie across a chunk's end.
MARGIN = 32
MEMORY = 200_000
LIMIT = 2048
_BLANKS = " \n\t\r"
#: Splitter patterns (published with the tokenizers) that match no white space.
SPLITS = [r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"]

Encoded = tuple[list[int], list[tuple[int, int]]]


def spliced(text: str, encode: Callable[[str], Encoded], ends: np.ndarray, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of text, encoded in overlapping chunks. ends: by token id, whether it is the last of a piece."""
    first, end = 0, min(chunk, len(text))  # tokens before `first` are counted
    ids, spans = _absolute(encode(text[:end]), 0)
    total = 0
    while end < len(text):
        wide, cut = overlap, None
        while cut is None:
            at = max(end - wide, first)
            stop = min(at + max(chunk, 2 * wide), len(text))
            right_ids, right_spans = _absolute(encode(text[at:stop]), at)
            cut = _boundary(text, _starts(ids, spans, ends), _starts(right_ids, right_spans, ends), at, end)
            if at == first:
                break
            wide *= 2
        if cut is None:  # the right chunk begins where the open one does and takes its place
            ids, spans, chunk = right_ids, right_spans, 2 * chunk
        else:
            i, j = cut
            total += i
            ids, spans, first = right_ids[j:], right_spans[j:], right_spans[j][0]
        end = stop
    return total + len(ids)


def _absolute(encoded: Encoded, at: int) -> Encoded:
    return encoded[0], [(a + at, b + at) for a, b in encoded[1]]


def _starts(ids: list[int], spans: list, ends: np.ndarray) -> dict[int, int]:
    """Places where a piece begins and the piece before it has ended, with the number of tokens before."""
    return {spans[i][0]: i for i in range(1, len(ids)) if ends[ids[i - 1]] and spans[i - 1][1] <= spans[i][0]}


def _boundary(text: str, left: dict[int, int], right: dict[int, int], at: int, end: int) -> tuple[int, int] | None:
    """Numbers of tokens (left chunk, right chunk) before the stable boundary nearest to the overlap's middle."""
    proven = [a for a in left.keys() & right.keys() if at < a < end and (text[a - 1] in _BLANKS or min(a - at, end - a) >= MARGIN)]
    if not proven:
        return None
    best = min(proven, key=lambda a: (abs(2 * a - at - end), a))
    return left[best], right[best]


def drops_blanks(config: dict) -> bool:
    """Whether a tokenizer's JSON says that no token and no rule reaches over white space.

    The normaliser composes, turns runs of white space into blanks and lower-cases; the splitter keeps only what its pattern finds, whose classes of characters
    have no white space, and everything after it works within a split; the model marks the last token of a word; no added token strips or holds white space; nothing else (post-processor,
    prefix blank, drop-out, unknown tokens that fuse) counts tokens across splits.
    """
    try:
        rules = config["normalizer"]["normalizers"] if config["normalizer"]["type"] == "Sequence" else [config["normalizer"]]
        blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        if blanks not in rules or any(r["type"] not in ("NFC", "Lowercase") for r in rules if r != blanks):
            return False
        split, *after = config["pre_tokenizer"]["pretokenizers"]
        pattern = split["pattern"]["Regex"]
        if split["type"] != "Split" or (split["behavior"], split["invert"]) != ("Removed", True) or pattern not in SPLITS:
            return False
        if any(x["type"] != "ByteLevel" or x["add_prefix_space"] or x["use_regex"] for x in after):
            return False
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(_BLANKS) or len(t["content"]) > MARGIN for t in config["added_tokens"]):
            return False
        model = config["model"]
        return model["type"] == "BPE" and not model["dropout"] and bool(model["end_of_word_suffix"]) and not config["post_processor"]
    except (KeyError, TypeError, ValueError):
        return False


class Counter:
    """Token counts of texts by one tokenizer of the `tokenizers` library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.by_pieces = drops_blanks(config)
        if self.by_pieces:
            mark, added = config["model"]["end_of_word_suffix"], {t["id"] for t in config["added_tokens"]}
            words = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(words.values()) + 1, bool)
            self.ends[[n for w, n in words.items() if w.endswith(mark) or n in added]] = True
        self.known: dict[str, int] = {}

    def encode(self, text: str) -> Encoded:
        x = self.tokenizer.encode(text, add_special_tokens=False)
        return x.ids, x.offsets

    def count(self, text: str) -> int:
        if not self.by_pieces:
            return len(self.encode(text)[0])
        if len(text) > HUGE:
            return spliced(text, self.encode, self.ends)
        known, total = self.known, 0
        for p in text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "):
            n = known.get(p)
            if n is None:
                n = len(self.tokenizer.encode(p, add_special_tokens=False))
                if len(p) <= 64:
                    if len(known) >= MEMORY:
                        known.clear()
                    known[p] = n
            total += n
        return total


_COUNTERS: dict[str, Counter] = {}


def counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs; path: the tokenizer's file, which every machine has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(path)
        count = _COUNTERS[path].count
        for b in batches:
            n = [count(t or "") for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), F.col("text").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
