"""Vocabulary trie intersected with a weighted Levenshtein automaton.

The automaton accepts every string within a budget of units of the query: a general insertion, deletion or substitution
costs two units, a confusion that scanning is known for costs one. Walking trie and automaton together retrieves all
vocabulary words within the budget, without looking at the rest of the vocabulary.

The trie is cut into subtrees by beginnings and ends of words, so a distributed search sends each vocabulary word to a
few shards only (``query_keys``, ``word_keys``, ``within_shard``) and together they find what the whole trie would.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

# What the scan shows, and what the page may have had in its place.
CONFUSIONS: tuple[tuple[str, str], ...] = (
    ("!", "i"), ("!", "l"), ("1", "l"), ("1", "i"), ("0", "o"), ("5", "s"), ("6", "é"), ("6", "b"), ("8", "b"), ("9", "g"), ("2", "z"),
    ("c", "e"), ("e", "c"), ("n", "u"), ("u", "n"), ("h", "b"), ("b", "h"), ("h", "li"), ("h", "tt"), ("m", "rn"), ("m", "in"), ("m", "ni"),
    ("rn", "m"), ("in", "m"), ("ni", "m"), ("nn", "m"), ("d", "cl"), ("cl", "d"), ("ii", "ü"), ("ii", "u"), ("u", "ii"), ("ſ", "f"), ("ſ", "s"), ("f", "ſ"), ("f", "s"), ("s", "f"),
    ("i", "l"), ("l", "i"), ("l", "t"), ("t", "l"), ("vv", "w"), ("w", "vv"), ("ri", "n"), ("n", "ri"), ("q", "g"), ("g", "q"), ("é", "e"), ("e", "é"),
    ("o", "c"), ("c", "o"), ("a", "o"), ("ü", "ii"), ("li", "h"), ("tt", "h"), ("0", "ö"), ("è", "é"), ("é", "è"), ("ß", "b"), ("b", "ß"), ("ò", "ö"),
)
CONFUSION, EDIT = 1, 2

_READ: dict[str, list[tuple[str, str]]] = defaultdict(list)
for _shown, _meant in CONFUSIONS:
    _READ[_shown[0]].append((_shown, _meant))


def prefixes(query: str, length: int = 2, budget: int = 2) -> set[str]:
    """The first ``length`` characters that words within ``budget`` confusions of ``query`` may have."""
    found, stack = set(), [(0, "", 0)]
    while stack:
        i, prefix, cost = stack.pop()
        if len(prefix) >= length or i >= len(query):
            found.add(prefix[:length])
            continue
        stack.append((i + 1, prefix + query[i], cost))
        if cost + CONFUSION <= budget:
            for shown, meant in _READ.get(query[i], ()):
                if query.startswith(shown, i):
                    stack.append((i + len(shown), prefix + meant, cost + CONFUSION))
    return found


def query_keys(query: str) -> list[str]:
    """Shards of the vocabulary in which the words within the budget of ``query`` lie; ``word_keys`` is the other side.

    A budget pays two confusions or one edit. Without an edit in the first two characters the word begins with one of the
    ``prefixes``; with one, all behind them stands, so it ends as the query does. Very short queries ask the short words.
    """
    keys = [f"F{prefix}" for prefix in sorted(prefixes(query))]
    return keys + [f"R{query[-2:]}" if len(query) >= 4 else f"S{query[-1:]}" if len(query) == 3 else "T"]


def word_keys(word: str) -> list[str]:
    """Shards that list a vocabulary word, four at most whatever the size of the corpus or of the cluster."""
    keys = [f"F{word[:2]}"]
    if len(word) >= 3:
        keys.append(f"R{word[-2:]}")
    if 2 <= len(word) <= 4:
        keys.append(f"S{word[-1]}")
    if len(word) <= 3:
        keys.append("T")
    return keys


def within_shard(key: str, words: Iterable[str], queries: Iterable[str]) -> list[tuple[str, str, int, int]]:
    """``(query, word, cost, edits)`` of one shard: what its key leaves to be found there, the query itself left out."""
    trie = Trie(words)
    first, last, confusions = {"F": (2, None, True), "T": (0, None, False)}.get(key[0], (0, 2, False))
    return [(q, v, cost, edits) for q in queries for v, (edits, cost) in trie.walk(q, 2, first, last, confusions).items() if cost]


class Trie:
    """Nested dicts by character; the key ``""`` holds the word that ends there."""

    def __init__(self, words: Iterable[str]) -> None:
        self.root: dict = {}
        for word in words:
            node = self.root
            for char in word:
                node = node.setdefault(char, {})
            node[""] = word

    def within(self, query: str, budget: int = 2) -> dict[str, int]:
        """Every word within ``budget`` units of ``query``, with its least cost; the query itself costs 0."""
        return {word: cost for word, (_, cost) in self.walk(query, budget).items()}

    def walk(self, query: str, budget: int = 2, first: int = 0, last: int | None = None, confusions: bool = True) -> dict[str, tuple[int, int]]:
        """``{word: (edits, cost)}`` within the budget, the least by number of general edits, then by cost.

        General edits are looked for from character ``first`` of the query on and before ``last``, confusions if wanted.
        """
        found: dict[str, tuple[int, int]] = {}
        seen: dict[tuple[int, int, int], int] = {}
        stack = [(self.root, 0, 0, 0)]
        end = len(query)
        last = end + 1 if last is None else last
        while stack:
            node, i, cost, edits = stack.pop()
            known = seen.get((id(node), i, edits))
            if known is not None and known <= cost:
                continue
            seen[(id(node), i, edits)] = cost
            if i == end:
                word = node.get("")
                if word is not None and (word not in found or (edits, cost) < found[word]):
                    found[word] = (edits, cost)
            else:
                child = node.get(query[i])
                if child is not None:
                    stack.append((child, i + 1, cost, edits))
                if confusions and cost + CONFUSION <= budget:
                    for shown, meant in _READ.get(query[i], ()):
                        if query.startswith(shown, i):
                            child = node
                            for char in meant:
                                child = child.get(char)
                                if child is None:
                                    break
                            if child is not None:
                                stack.append((child, i + len(shown), cost + CONFUSION, edits))
            if cost + EDIT <= budget and first <= i < last:
                if i < end:
                    stack.append((node, i + 1, cost + EDIT, edits + 1))
                for char, child in node.items():
                    if char:
                        stack.append((child, i, cost + EDIT, edits + 1))
                        if i < end and char != query[i]:
                            stack.append((child, i + 1, cost + EDIT, edits + 1))
        return found
