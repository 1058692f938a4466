import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from slotcast.llm.merges import Merges, Words

LETTERS = ["a", "e", "t", "h", "in", "er", " ", "é", "語", "🙂", "1", "-", "ß", "\n", "the"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_merged_as_the_tokenizer_does(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    pick = random.Random(3)
    words = ["".join(pick.choice(LETTERS) for _ in range(pick.randint(1, 40))).encode() for _ in range(4_000)]
    words += [b"", b"a", b"a", b"aa" * 300, bytes(range(256)), b"th" * 512, b"x" * 1025, "語".encode() * 900]
    offsets = np.cumsum([0, *map(len, words)])
    for block in (1 << 17, 300):
        merges = Merges(tokenizer.to_str(), tokenizer.model, block)
        ids, n = merges(np.frombuffer(b"".join(words), np.uint8), offsets)
        ends = np.cumsum(n).tolist()
        for word, a, b in zip(words, [0, *ends], ends):
            spelled = word.decode("latin-1").translate(merges.letters)
            assert ids[a:b].tolist() == ([t.id for t in tokenizer.model.tokenize(spelled)] if word else [])
        assert len(merges(np.empty(0, np.uint8), np.zeros(1, np.int64))[0]) == 0


@pytest.mark.parametrize("name,blank", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_words_of_any_characters(name, blank):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    pick = random.Random(4)
    parts = [*LETTERS, "É", "×", "÷", "ÿ", "Ÿ", "'s", "<|", "A", "Z", "42", "_", "...", "\u00a0", "Ã", "\t"]
    words = ["".join(pick.choice(parts).replace(" ", "") for _ in range(pick.randint(0, 9))) for _ in range(4_000)]
    words += ["", "<|endoftext|>", "ÀÖØßöø", "A" * 5_000, "1" * 3_000]

    def ids(word):
        return np.array(tokenizer.encode(" " + word if blank else word, add_special_tokens=False).ids, np.uint32)

    cut = Words(Merges(tokenizer.to_str(), tokenizer.model), lambda w: ids(w).tobytes(), blank, not blank, not blank)
    for some in (words, words[:1], ["'"], ["a"]):
        flat, starts, n = cut(pa.array(["x", *some], pa.string())[1:])
        for word, a, k in zip(some, starts.tolist(), n.tolist()):
            assert flat[a : a + k].tolist() == ids(word).tolist()
    assert len(cut(pa.array([], pa.string()))[1]) == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        Merges('{"model": {"type": "WordPiece"}}', None)
