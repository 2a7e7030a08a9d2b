"""Token ids of a public byte-level BPE vocabulary.

The vocabulary is the one ``tokenizers`` reads as ``byte_bpe_50k.json``; its
rank file gives the same ids about four times faster (tests compare the two on
every fixture), which is what brings tokenising whole corpora within budget.
The vocabulary's added token is one id wherever its string stands in a text, as
it is for ``tokenizers``; the text before and behind it is tokenised on its own.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import regex
import tiktoken

#: Fixed value: the vocabulary's pre-token pattern.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
             r"|\s+(?!\S)|\s+")

#: Fixed value: the vocabulary's added token and its id.
ADDED, ADDED_ID = "<|endoftext|>", 50256

#: Longer texts are encoded in parts: the encoder's pattern engine gives up on
#: about a million blanks in a row.  Parts end where pre-tokens do, so ids are the same.
LONG_TEXT = 200_000

#: Characters past its own end that can decide a pre-token: a contraction looks
#: at three characters from its start, white space at the character beyond the one
#: it leaves to the next word, where the added token may begin.
LOOKAHEAD = len(ADDED) + 2

find_pre_tokens = regex.compile(PRE_TOKEN).finditer


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """One encoding per worker process and vocabulary file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PRE_TOKEN, mergeable_ranks=ranks,
                             special_tokens={ADDED: ADDED_ID})


def encoder(path: str) -> Callable[[str], list[int]]:
    """Text to ids, added tokens included."""
    public = encoding(path)
    ordinary = public.encode_ordinary

    def encode_short(text: str) -> list[int]:
        return public.encode(text, allowed_special="all") if ADDED in text else ordinary(text)

    def encode(text: str) -> list[int]:
        if len(text) <= LONG_TEXT:
            return encode_short(text)
        ids: list[int] = []
        for start, stop, alone in parts(text, LONG_TEXT):
            # A pre-token on its own needs the byte-pair step only, at any length.
            ids += public._core_bpe.encode_single_piece(text[start:stop].encode()) if alone \
                else encode_short(text[start:stop])
        return ids

    return encode


def parts(text: str, longest: int) -> Iterator[tuple[int, int, bool]]:
    """(start, stop, alone) of consecutive parts: one pre-token alone if it is blank or
    longer than ``longest``, else a run of others that is about as long at most.

    A run neither begins behind blanks nor ends in them, so that scanning it by
    itself finds the pre-tokens it has in the text.
    """
    start = last = 0
    for end in pre_token_ends(text):
        token = text[last:end] if end - last <= longest else ""
        if not token or token.isspace():
            if start < last:
                yield start, last, False
            yield last, end, True
            start = end
        elif end - start >= longest:
            yield start, end, False
            start = end
        last = end
    if start < len(text):
        yield start, len(text), False


def pre_token_ends(text: str, begin: int = 0) -> Iterator[int]:
    """Where each pre-token from ``begin`` on ends; an added token is one."""
    while True:
        at = text.find(ADDED, begin)
        for match in find_pre_tokens(text, begin, len(text) if at < 0 else at):
            yield match.end()
        if at < 0:
            return
        begin = at + len(ADDED)
        yield begin
