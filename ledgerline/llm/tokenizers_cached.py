"""Public tokenizers for use inside tasks: counts with a memo of chunks, and ids.

A byte-pair tokenizer first cuts a text into pre-tokens and encodes each alone,
so the token count of a text is the sum over chunks whose borders are always
pre-token borders.  Words repeat far more often than texts, so each Python
worker remembers the counts of chunks that it has met; the memo is emptied when
it reaches ``MEMO`` entries.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

MEMO = 400_000


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class ChunkCounter:
    """Token counts of texts for a tokenizer that drops white space before encoding.

    Chunks that are new are encoded together, with a bar between them: alone between
    spaces it is one pre-token and one token, so it marks the borders.
    """

    BAR = "|"

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.memo: dict[bytes, int] = {}
        bar = self._encode(self.BAR)
        self.bar = bar[0] if len(bar) == 1 else None

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, chunks: set[bytes]) -> dict[bytes, int]:
        new: dict[bytes, int] = {}
        plain = [c for c in chunks if b"|" not in c] if self.bar is not None else []
        for at in range(0, len(plain), 5_000):
            part = plain[at : at + 5_000]
            ids = np.asarray(self._encode(f" {self.BAR} ".join([c.decode() for c in part])))
            borders = np.flatnonzero(ids == self.bar)
            if len(borders) == len(part) - 1:
                new.update(zip(part, (np.diff(borders, prepend=-1, append=len(ids)) - 1).tolist()))
        for c in chunks:
            if c not in new:
                new[c] = len(self._encode(c.decode()))
        return new

    def counts(self, texts: list[str]) -> list[int]:
        split = [t.encode().split() for t in texts]
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        found = [list(map(memo.get, chunks)) for chunks in split]
        missing = {c for chunks, counts in zip(split, found) if None in counts for c, n in zip(chunks, counts) if n is None}
        if not missing:
            return list(map(sum, found))
        new = self._learn(missing)
        memo.update(new)
        return [
            sum([new[c] if n is None else n for c, n in zip(chunks, counts)]) if None in counts else sum(counts)
            for chunks, counts in zip(split, found)
        ]


@lru_cache(maxsize=2)
def chunk_counter(path: str) -> ChunkCounter:
    return ChunkCounter(path)


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level BPE files use for the 256 bytes."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {chr(b): b for b in printable}
    rest = [b for b in range(256) if b not in printable]
    return stand_in | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevelEncoder:
    """Ids of texts for a byte-level BPE file without a normalizer.

    The ranks are read from the ``tokenizers`` file; ``tiktoken`` splits and merges
    whole texts by the same pattern and ranks, which is faster than to look up
    remembered chunks.  Added special strings inside a text become their ids, as the
    file's library does by default.  White space of a few hundred thousand characters
    on end exceeds the pattern's stack: such a text goes through ``tokenizers``.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = _byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(alphabet[ch] for ch in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        self.path = path
        self.special = set(special)
        self.encoding = tiktoken.Encoding(
            "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        try:
            ids = self.encoding.encode_to_numpy(text, allowed_special=self.special)
        except ValueError:
            ids = load_tokenizer(self.path).encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.asarray(ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def byte_level_encoder(path: str) -> ByteLevelEncoder:
    return ByteLevelEncoder(path)
