import random

from kindred.llm.queries import vocabulary
from kindred.llm.trie_bpe import TrieEncoder, Vocabulary


def test_undone_merges_agree_with_full_encoding():
    """Pairs at random, pairs that merge, overlapping ends and a token beside itself."""
    encoder = TrieEncoder(Vocabulary.load(vocabulary()))
    v, draw = encoder.v, random.Random(7)
    ids, merges = list(v.token.values()), list(v.merge)
    pairs = [(draw.choice(ids), draw.choice(ids)) for _ in range(4000)] + draw.sample(merges, 4000) + [(i, i) for i in draw.sample(ids, 2000)]
    for _ in range(4000):
        whole = v.bytes[draw.choice(ids)]
        pairs.append((v.token[whole], v.token.get(whole[draw.randrange(len(whole)) :], v.token[b"a"])))
    assert all(encoder.stand_apart(a, b) == (encoder.plain(v.bytes[a] + v.bytes[b]) == [a, b]) for a, b in pairs)


def test_tokens_of_several_merges_are_encoded_in_full():
    encoder = TrieEncoder(Vocabulary.load(vocabulary()))
    left, right = next(iter(encoder.v.merge))
    encoder.v.several.add(left)
    assert not encoder.stand_apart(left, right)
