"""Token ids and counts by public tokenizer files, exactly as the libraries give them
for whole texts."""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # one task, one core


class ByteIds:
    """Ids by a ``tokenizers`` JSON file, as little-endian unsigned 32-bit bytes, without
    added special tokens.

    Texts of plain Latin characters are encoded by tiktoken over the same vocabulary
    where that provably gives the same ids (see ``_ranks``), several times faster;
    all others, and those that hold a special token's string, by ``tokenizers``.
    """

    _held: dict[str, "ByteIds"] = {}
    #: Anything but line feeds and printable characters up to Latin Extended-B, on whose
    #: classes (letter, number, space) all regular expression engines agree.
    _other = re.compile("[^\n\x20-\x7e\xa1-\u024f]")

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        path = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        self.special = [t["content"] for t in d.get("added_tokens", [])]
        self.ranked = self._ranks(name, d)

    @classmethod
    def of(cls, name: str) -> "ByteIds":
        if name not in cls._held:
            cls._held[name] = cls(name)
        return cls._held[name]

    @staticmethod
    def _ranks(name: str, d: dict):
        """The same vocabulary as ranks, or None. The ids are the same if the file has the
        byte-level pre-tokenizer with its own pattern and nothing before or after it,
        every id stands for the same bytes, and merges are listed in the order of the
        ids they make, so that merging by list and by rank are one and the same."""
        import public_tokenizers
        import tiktoken

        path = public_tokenizers.path(name.removesuffix(".json") + ".tiktoken")
        pre, model = d.get("pre_tokenizer") or {}, d["model"]
        if not os.path.exists(path) or model.get("type") != "BPE" or model.get("ignore_merges") or model.get("dropout") \
                or d.get("normalizer") or d.get("post_processor") or pre.get("type") != "ByteLevel" \
                or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            return None
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]    # byte-level letters
        letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        try:
            vocab = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items()}
        except KeyError:
            return None
        made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        if vocab != ranks or None in made or made != sorted(set(made)):
            return None
        return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.ranked and not self._other.search(text) and not any(s in text for s in self.special):
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def many(self, texts) -> list[bytes]:
        return [self(t) for t in texts]


class Counts:
    """Token counts of whole texts by one tokenizer file (``.json`` or ``.model``)."""

    _held: dict[str, "Counts"] = {}

    def __init__(self, name: str):
        import public_tokenizers

        self.ids = self.pieces = None
        if name.endswith(".json"):
            self.ids = ByteIds.of(name)
            return
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))

    @classmethod
    def of(cls, name: str) -> "Counts":
        if name not in cls._held:
            cls._held[name] = cls(name)
        return cls._held[name]

    def many(self, texts) -> list[int]:
        if self.ids is not None:
            return [len(x) // 4 for x in self.ids.many(texts)]
        return [len(self.pieces.encode(t, num_threads=1)) if t else 0 for t in texts]
