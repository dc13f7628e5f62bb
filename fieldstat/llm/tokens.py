"""Access to public tokenizer files from inside tasks.  Files are named by a
path parameter; each Python worker loads a file once."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable
from functools import cache

#: Split pattern of the byte-level vocabulary (fixed value, published with it).
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: White-space characters in a row that are kept from ``tiktoken`` (it fails somewhere above 700,000).
LONG_BLANKS = 50_000
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_BLANKS)


def vocabulary_path(name: str) -> str:
    """Where the installed tokenizer package keeps ``name``."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@cache
def tokenizer(path: str):
    """The ``tokenizers`` object of a JSON file, without truncation and padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@cache
def encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids under a byte-level vocabulary: a rank file (``.tiktoken``) or a ``tokenizers`` JSON file.

    A rank file beside a JSON file of the same name holds the same vocabulary and
    is read by ``tiktoken``, which is faster; ``tests/llm`` checks that both give
    the same ids.  ``tiktoken`` fails on very long runs of white space: texts with
    such runs are encoded by ``tokenizers``, or, where there is only a rank file,
    cut at the runs.  Special tokens of the JSON file found in a text become
    their ids, as that library does.
    """
    if path.endswith(".json"):
        ranks_path = path.removesuffix(".json") + ".tiktoken"
        special = {t.content: i for i, t in tokenizer(path).get_added_tokens_decoder().items()}
    else:
        ranks_path, special = path, {}
    if not os.path.exists(ranks_path):
        loaded = tokenizer(path)
        return lambda text: loaded.encode(text, add_special_tokens=False).ids
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("ranks", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens=special)
    plain = (lambda text: coder.encode(text, allowed_special="all")) if special else coder.encode_ordinary

    def encode(text: str) -> list[int]:
        if len(text) < LONG_BLANKS or not _BLANKS.search(text):
            return plain(text)
        if path.endswith(".json"):
            return tokenizer(path).encode(text, add_special_tokens=False).ids
        return _at_blanks(coder, text)

    return encode


def _at_blanks(coder, text: str) -> list[int]:
    """Ids of a text cut where the pattern cuts it too: a run of white space is one piece but for its last
    character, which goes with what follows."""
    ids, at = [], 0
    for m in _BLANKS.finditer(text):
        stop = m.end() if m.end() == len(text) else m.end() - 1
        ids += coder.encode_ordinary(text[at:m.start()])
        ids += coder._encode_single_piece(text[m.start():stop])
        at = stop
    return ids + coder.encode_ordinary(text[at:])
