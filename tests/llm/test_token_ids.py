"""Ids of the encoder against those of the library, in batches that share pieces."""

import random

from tokenizers import Tokenizer

from tidemark.llm import token_ids
from tidemark.llm.token_ids import TextEncoder, vocabulary_path

ATOMS = [" ", " ", " ", "  ", "\n", "\n", "\t", "\r\n", "a", "Word", "two.\nLines", "'s", "'ll", "don't", "é", "日本", "42", "½", ".", ",", "!?", "…", "......",
         "-", "###", "\x1c", "\x85", " ", "​", "́", "Ġ", "Ċ", "😀", "<|endoftext|>", "x" * 50]


def test_ids_equal_those_of_the_library():
    rnd = random.Random(5)
    texts = ["", " ", "   ", "\n", "\n\n", "a", "a\n", "\na", "a\n b", "Foo.\nBar, baz", "end.\n\nNext", "word\n" * 500, "x" * 30_000]
    texts += ["".join(rnd.choice(ATOMS) for _ in range(rnd.randint(0, 14))) for _ in range(12_000)]
    ours, theirs = TextEncoder(vocabulary_path()), Tokenizer.from_file(vocabulary_path())
    for at in range(0, len(texts), 900):
        part = texts[at:at + 900]
        wanted = theirs.encode_batch(part, add_special_tokens=False)
        assert [ids.tolist() for ids in ours.encode(part)] == [w.ids for w in wanted]
    assert all(len(w) <= 40 for cache in ours.after.values() for w in cache)


def test_words_in_use_stay_known(monkeypatch):
    """A word that every batch holds is encoded once, however many others come and go."""
    ours = token_ids.TextEncoder(token_ids.vocabulary_path())
    monkeypatch.setattr(token_ids, "CACHE_WORDS", 20)
    asked, library = [], ours._ids
    monkeypatch.setattr(ours, "_ids", lambda text: asked.append(text) or library(text))
    for batch in range(30):
        text = " ".join(["The", "common", *(f"w{'abcdefghij'[batch % 10]}{k}x{batch}" for k in range(7))])
        assert ours.encode([text])[0].tolist() == library(text).tolist()
    assert sum("common" in text for text in asked) == 1
    assert len(list(ours.after[" "])) <= 20


def test_words_with_odd_blanks_alone():
    ours = token_ids.TextEncoder(token_ids.vocabulary_path())
    for text in ("", " ", "\n", "a", "a\tb c", "\nab c", "a  b　c", "ab.\nCd, ef!\ng", "x \n y", "\x1c a", "aß.,;: b#, é!"):
        assert [x.tolist() for x in ours.encode([text])] == [ours._ids(text).tolist()]
