"""A lexicon trie walked by Levenshtein automata, as one table of states."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from roadpulse.llm import hashing


@dataclass(frozen=True)
class Entry:
    """A term, or with ``stem`` the beginning of terms; ``edits`` is how far a word may lie from it."""

    term: str
    stem: bool = False
    edits: int = 0


class Automaton:
    """Deterministic states for "within the allowed edits of an entry".

    A state stands for a set of (trie node, edits so far). Bytes that occur in no entry behave alike, so
    the table has a column for each byte of the entries and one for all others. State 0 is dead.
    """

    def __init__(self, entries: list[Entry]):
        self.entries = entries
        children: list[dict[int, int]] = [{}]
        ends: list[list[int]] = [[]]
        allowed = [0]
        for number, entry in enumerate(entries):
            node = 0
            allowed[0] = max(allowed[0], entry.edits)
            for byte in entry.term.encode():
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ends.append([])
                    allowed.append(0)
                node = children[node][byte]
                allowed[node] = max(allowed[node], entry.edits)
            ends[node].append(number)
        letters = sorted({b for c in children for b in c})
        self.column = np.zeros(256, np.int64)
        self.column[letters] = np.arange(1, len(letters) + 1)

        def closed(states: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
            """With the letters of a term that the word leaves out."""
            todo, seen = list(states), {}
            while todo:
                node, edits = todo.pop()
                if edits > allowed[node] or seen.get(node, 99) <= edits:
                    continue
                seen[node] = edits
                todo += [(child, edits + 1) for child in children[node].values()]
            return frozenset(seen.items())

        def after(states: frozenset[tuple[int, int]], letter: int | None) -> frozenset[tuple[int, int]]:
            found: set[tuple[int, int]] = set()
            for node, edits in states:
                found.add((node, edits + 1))
                for byte, child in children[node].items():
                    found.add((child, edits + (byte != letter)))
            return closed(found)

        def accepted(states: frozenset[tuple[int, int]], stem: bool) -> tuple[int, int]:
            best = [
                (edits, number)
                for node, edits in states
                for number in ends[node]
                if entries[number].stem == stem and edits <= entries[number].edits
            ]
            return min(best, default=(0, -1))

        start = closed({(0, 0)})
        numbers, order, rows = {frozenset(): 0, start: 1}, [frozenset(), start], []
        for states in order:  # grows on the way
            row = []
            for letter in [None, *letters]:
                follow = after(states, letter) if states else frozenset()
                if follow not in numbers:
                    numbers[follow] = len(order)
                    order.append(follow)
                row.append(numbers[follow])
            rows.append(row)
        self.table = np.array(rows, np.int64)
        whole = [accepted(s, False) for s in order]
        begun = [accepted(s, True) for s in order]
        self.whole = np.array([n for _, n in whole])
        self.whole_edits = np.array([e for e, _ in whole])
        self.begun = np.array([n for _, n in begun])

    def find(self, data: np.ndarray, found: hashing.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, entry, edits) of the words that an entry accepts, in order; data in lower case.

        All words take a step at a time; those whose state is dead leave.
        """
        at, state = np.arange(len(found.start)), np.ones(len(found.start), np.int64)
        length, step = found.end - found.start, 0
        hits = []
        while len(at):
            over = length[at] == step
            for done, entry, edits in (
                (over, self.whole[state], self.whole_edits[state]),
                (np.ones(len(at), bool), self.begun[state], np.zeros(len(at), np.int64)),
            ):
                hit = done & (entry >= 0)
                if hit.any():
                    hits.append((at[hit], entry[hit], edits[hit]))
            over |= self.begun[state] >= 0
            at, state = at[~over], state[~over]
            state = self.table[state, self.column[data[found.start[at] + step]]]
            live = state != 0
            at, state = at[live], state[live]
            step += 1
        if not hits:
            none = np.zeros(0, np.int64)
            return none, none, none
        word, entry, edits = (np.concatenate([h[k] for h in hits]) for k in range(3))
        order = np.lexsort((entry, edits, word))
        first = np.ones(len(order), bool)
        first[1:] = word[order][1:] != word[order][:-1]
        order = order[first]
        return word[order], entry[order], edits[order]


class Lexicon:
    """Automata over blocks of the entries: a table's states grow faster than its entries, so these are not all in one."""

    def __init__(self, entries: list[Entry], block: int = 200):
        self.entries = entries
        self.blocks = [(k, Automaton(entries[k : k + block])) for k in range(0, len(entries), block)]

    def find(self, data: np.ndarray, found: hashing.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As one automaton over all entries finds them: of a word, the entry of fewest edits, the first of equals."""
        hits = []
        for base, automaton in self.blocks:
            word, entry, edits = automaton.find(data, found)
            hits.append((word, entry + base, edits))
        word, entry, edits = (np.concatenate([h[k] for h in hits]) for k in range(3))
        order = np.lexsort((entry, edits, word))
        first = np.ones(len(order), bool)
        first[1:] = word[order][1:] != word[order][:-1]
        order = order[first]
        return word[order], entry[order], edits[order]
