"""Token ids of a byte-level tokenizer file."""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import tiktoken


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such files: itself if it prints, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """Ids as the `tokenizers` library gives them for the file, no special tokens added.

    A special token's own text, where a text has it, is that token, as it is by default there. The merges are those of the file, done by `tiktoken`, which takes a quarter of the time. That is the
    same if ids ascend with the merges and words are split by the usual pattern, which is checked.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        words, model = spec["pre_tokenizer"], spec["model"]
        if words["type"] != "ByteLevel" or words["add_prefix_space"] or not words["use_regex"]:
            raise ValueError(f"{path} does not split words as byte-level tokenizers do")
        added = spec["added_tokens"]
        if any(not t["special"] or t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"{path} has tokens that take more than their own text")
        special = {t["content"]: t["id"] for t in added}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if spec["normalizer"] or model["type"] != "BPE" or merged != sorted(merged):
            raise ValueError(f"{path} does not merge in the order of ids")
        byte = byte_letters()
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        self._bpe = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._special = [t.encode() for t in special]

    def encode(self, text: bytes) -> bytes:
        """The ids as 32-bit integers, little-endian."""
        if any(t in text for t in self._special):
            return np.array(self._bpe.encode(text.decode(), allowed_special="all"), "<u4").tobytes()
        return np.array(self._bpe.encode_ordinary(text.decode()), "<u4").tobytes()
