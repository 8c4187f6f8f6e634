"""Quick ways to words and their ids, against the plain ones."""

import random
import string

import public_tokenizers

from daybook.llm import bin_slack


def test_words_are_parted_alike_at_every_character():
    for c in map(chr, range(0x110000)):
        text = f"a{c}b \t{c}"
        assert bin_slack.words_of(text) == bin_slack._WORDS.findall(text)


def test_plain_letters_need_no_pattern(monkeypatch):
    ids = bin_slack.WordIds(str(public_tokenizers.path("word_bpe_49k.json")))
    dealt = random.Random(3)
    words = ["".join(dealt.choices(string.ascii_letters, k=dealt.choice([1, 5, 12, 70]))) for _ in range(500)]
    monkeypatch.setattr(bin_slack.WordIds, "PATTERN", None)
    for word in words:
        assert ids._ids(word) == ids.tokenizer.encode(word, add_special_tokens=False).ids
