import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from edge import TEXTS, documents, nothing
from tokenizers import Tokenizer

from alertloom.llm import bpe, tokens

PATH = public_tokenizers.path(bpe.VOCABULARY)
HARD = ["", " ", "  ", "a  b   c", "\n \n b", "foo\n \nbar", " \n  x", "I'll don't 's", "日本語 テキスト 123 4567", "İstanbul ΣΑΣ", "😀 👍🏽 x", "\t\ttab",
        "<|endoftext|> a", "ab" * 300, "\x1c a \x1c", "aaa aaaa aaaaaaaaaa", "ſKelvin K", "Ça été! Où? a|b"]


HARD += ["a\nb", "\na", "a\n", "a\n\nb", "a.\n12 x", "\n", "é\nÉté.\nx", "a\n\n", "x \n", "a\n'll b", "Ab.\nCd, ef\n<|endoftext|>\n|"]


def texts():
    rnd = random.Random(1)
    odd = ["".join(rnd.choice(" \n\ta.b,éЖ日1' s!|ſ ") for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    runs = ["".join(rnd.choice("ab") for _ in range(rnd.randint(2, 60))) for _ in range(500)]
    words = [" ".join("".join(rnd.choice("thinerao") for _ in range(rnd.randint(1, 30))) for _ in range(6)) for _ in range(500)]
    return HARD + odd + runs + words


def test_ids_are_those_of_the_rank_files_own_library():
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})
    all_texts = texts()
    for text, ids in zip(all_texts, bpe.encoder(PATH).encode(all_texts)):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text), text


@pytest.mark.parametrize("name, words", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_pieces_give_the_ids_of_whole_texts(name, words):
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    whole.encode_special_tokens = True
    all_texts = texts()
    for text, ids in zip(all_texts, tokens.from_file(public_tokenizers.path(name), words).encode(all_texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name, words", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_a_table_of_few_pieces_gives_the_same_ids(monkeypatch, name, words):
    """Generations follow each other many times; a piece that is asked for again and again is encoded once."""
    monkeypatch.setattr(tokens, "PIECES", 50)
    all_texts = [t + " frequent" for t in texts()]
    coder = (tokens.WordEncoder if words else tokens.ByteEncoder)(Tokenizer.from_file(public_tokenizers.path(name)))
    seen, piece = [], coder.pieces.encode
    coder.pieces.encode = lambda p: seen.append(p) or piece(p)
    got = coder.encode([x for t in all_texts for x in t.split(" ")] if words else all_texts)
    assert len(coder.pieces) <= 50 and len(coder.pieces.old) <= 50 and len(seen) > 500
    assert seen.count(b"frequent" if words else "frequent") == 1
    if not words:
        whole = Tokenizer.from_file(public_tokenizers.path(name))
        whole.encode_special_tokens = True
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [whole.encode(t, add_special_tokens=False).ids for t in all_texts]


def test_decoding_joins_split_characters():
    table = bpe.byte_table(PATH)
    for text, ids in zip(HARD, bpe.encoder(PATH).encode(HARD)):
        ids = np.frombuffer(ids, "<u4").tolist()
        assert bpe.decode(ids, table).decode() == text
        assert "".join(bpe.decode_parts([[i] for i in ids], table)) == text
        data, starts, at = text.encode(), [], 0
        for i in ids:
            starts.append(sum((b & 0xC0) != 0x80 for b in data[: at + 1]) - 1)
            at += len(table[i])
        assert bpe.char_starts(text, np.array(ids, np.int64), table).tolist() == starts


def test_documents(spark):
    docs = documents(spark)
    encoded = bpe.encode_documents(docs, offsets=True)
    assert encoded.columns == ["doc_id", "ids", "char_starts"] and all(len(r["ids"]) == len(r["char_starts"]) for r in encoded.collect())
    decoded = bpe.decode_documents(bpe.encode_documents(docs)).collect()
    assert sorted((str(r["doc_id"]), bytes(r["decoded"]).decode()) for r in decoded) == sorted((str(i), t or "") for i, t in TEXTS)
    assert bpe.decode_documents(bpe.encode_documents(nothing(spark))).count() == 0
