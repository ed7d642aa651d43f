"""Token ids from a tokenizer file, with exact caches of what its rules make independent."""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np

# Python classes and the tokenizer's Unicode classes agree on these characters: ASCII without odd
# controls and the Latin letters U+00C0 to U+024F. Other texts go to the tokenizer as a whole.
LATIN = r"A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = re.compile(rf"[\t-\r\x20-\x7e{LATIN}]*")
# fixed value: the splitting pattern of byte-level BPE
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 400_000


class Encoder:
    """``ids(texts)`` and ``counts(texts)`` as ``tokenizers`` gives them with
    add_special_tokens=False. Two kinds of tokenizer have a faster way to the same ids:

    * plain byte-level BPE: ``tiktoken`` with ranks read from the same file, for texts whose
      characters leave no doubt about the pattern's classes and that hold no added token. It is
      used only if the file's merges are numbered in their order, as ranks must be;
    * splitters that drop white space: the words between ASCII white space are encoded by the
      tokenizer one by one, once, and remembered (at most CACHE of them).
    """

    def __init__(self, path: str):
        # A task has one core; the library's own threads would only take it from others.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        pre, normal = spec.get("pre_tokenizer") or {}, json.dumps(spec.get("normalizer"))
        self.pieces = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        self.fast = _ranked(spec["model"]) if self.pieces else None
        first = (pre.get("pretokenizers") or [{}])[0]
        rules = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
                        and r"[^\s" in first["pattern"].get("Regex", "") and set(rules) <= {"NFC", "Replace", "Lowercase"}
                        and normal.count('"Replace"') <= 1 and not any(a.split() != [a] for a in self.added))
        self.known: dict = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)] if texts else []

    def _learn(self, parts: set, value) -> None:
        new = parts.difference(self.known)
        if not new:
            return
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = parts
        strings = [p.decode("utf-8") if isinstance(p, bytes) else p for p in new]
        self.known.update(zip(new, map(value, self.encode(strings))))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        whole = []
        for i, text in enumerate(texts):
            if self.fast and PLAIN.fullmatch(text) and not any(a in text for a in self.added):
                out[i] = self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")
            else:
                whole.append(i)
        for i, v in zip(whole, self.encode([texts[i] for i in whole])):
            out[i] = np.array(v, dtype="<u4")
        return out

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return [len(v) for v in self.encode(texts)]
        split = [text.encode("utf-8").split() for text in texts]
        self._learn(set(chain.from_iterable(split)), len)
        return [sum(map(self.known.__getitem__, parts)) for parts in split]


def _ranked(model: dict):
    """A tiktoken encoding of a BPE model, or None where ids are not ranks."""
    import tiktoken

    if model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    # Byte-level vocabularies write a printable byte as itself and the n-th other byte as character 256 + n.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in printable)}
    vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(c not in vocab for c in byte_of):
        return None
    ids = [vocab.get(a + b) for a, b in merges]
    if None in ids or any(x >= y for x, y in zip(ids, ids[1:])) or max(vocab[c] for c in byte_of) >= ids[0]:
        return None
    ranks = {bytes([b]): vocab[c] for c, b in byte_of.items()} | {bytes(map(byte_of.__getitem__, a + b)): i for (a, b), i in zip(merges, ids)}
    return tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
