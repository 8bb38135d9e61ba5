"""Encoding of short pieces with a byte-level BPE file, for operators that encode each
distinct piece once."""

from __future__ import annotations

import json
import os

#: Below this code point the two installed libraries agree on letters, numbers and
#: white space (tests check every one); pieces with others go to the file's own library.
AGREED = "\u0558"
#: Fixed value: the pre-token pattern of byte-level BPE files with ``use_regex``.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict[str, object] = {}


def load_tokenizer(path: str):
    """The library's tokenizer of ``path``, kept for the life of the Python worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        if path.endswith(".model"):
            import sentencepiece

            _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            _LOADED[path] = tok
    return _LOADED[path]


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 stands for itself, the other bytes are numbered from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_bytes(path: str) -> list[bytes | None]:
    """Bytes of every id's piece; None for an id without one."""
    tok, of = load_tokenizer(path), byte_of_char()
    vocab = tok.get_vocab()
    out: list[bytes | None] = [None] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        known = all(c in of for c in piece)
        out[i] = bytes(of[c] for c in piece) if known else piece.encode()
    return out


class ByteBPE:
    """Ids of pieces cut by ``spaced_pieces``. ``rank_equal`` holds if every merge makes
    the token whose id is its place in the merge list; merging by lowest id is then
    merging by the list, and the faster library may do it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.cuttable = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                         and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                         and model.get("type", "BPE") == "BPE" and not model.get("ignore_merges")
                         and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                                     or " " in t["content"] for t in spec.get("added_tokens", [])))
        self.tok = load_tokenizer(path)
        vocab, merges = model["vocab"], model.get("merges", [])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        made = [vocab.get("".join(p)) for p in pairs]
        rank_equal = self.cuttable and made == list(range(256, 256 + len(pairs)))
        self.fast = None
        if rank_equal:
            import tiktoken

            of = byte_of_char()
            ranks = {bytes(of[c] for c in k): v for k, v in vocab.items() if v < 256 + len(pairs) and k not in self.added}
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, piece: str) -> list[int]:
        if self.fast and max(piece, default="") < AGREED and not any(a in piece for a in self.added):
            return self.fast(piece)
        return self.tok.encode(piece, add_special_tokens=False).ids


_BPE: dict[str, ByteBPE] = {}


def byte_bpe(path: str) -> ByteBPE:
    if path not in _BPE:
        _BPE[path] = ByteBPE(path)
    return _BPE[path]
