"""Weighted finite-state transducer of a SentencePiece model.

Three machines are compiled from a model file and composed on the fly:

* the normaliser N: adds the dummy space in front of a text that is not empty
  and rewrites ``' '`` as U+2581 (models with a character map of their own are
  refused, there is no silent approximation);
* the lexicon L: a trie whose final nodes emit a piece.  A character without a
  piece of its own takes the byte arcs: one byte piece per UTF-8 byte, or
  ``<unk>`` in a model without byte fallback;
* the grammar G over pieces.  For a unigram model it has one state and an arc
  of weight ``-score`` per piece.  For a BPE model its states are the last
  piece, and the arc p -> t has weight 0 where the merges of the model keep
  p and t apart in the string pt, infinity elsewhere.  A piece sequence is the
  output of BPE exactly if all its neighbours are kept apart (a first merge
  across a boundary only depends on the two pieces beside it), so a BPE
  lattice holds one path of finite weight.

``Machine`` is the tropical-semiring determinisation of N . L . G, built
lazily: a state is the set of unfinished pieces, each with the grammar state
it started from and its residual weight.  Equal sets are one state, so
transitions learnt on one text serve all others.  Each transition emits the
best last piece at its position and the change of the piece count; the
shortest path of a composed input is read back from those emissions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

SPACE = "▁"
UNK = -1       # grammar state after a character without a piece
START = -2     # grammar state before the first character
UNK_PENALTY = 10.0
NEVER = float("-inf")


@dataclass
class Model:
    """What the machines need of a model file."""

    pieces: list[str]
    scores: list[float]
    usable: list[bool]              # normal or user-defined pieces
    byte_ids: list[int] = field(default_factory=list)  # empty without byte fallback
    unk_id: int = 0
    kind: str = "bpe"
    dummy_prefix: bool = True
    control: list[bool] = field(default_factory=list)

    @classmethod
    def load(cls, path: str) -> "Model":
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only the identity normaliser without white-space removal can be compiled")
        if not norm.escape_whitespaces or train.treat_whitespace_as_suffix:
            raise ValueError("the normaliser must escape spaces as prefixes")
        kinds = {1: "unigram", 2: "bpe"}
        if train.model_type not in kinds:
            raise ValueError("unigram and BPE models only")
        kind_of = [p.type for p in proto.pieces]   # 1 normal 2 unknown 3 control 4 user 5 unused 6 byte
        if 4 in kind_of:
            raise ValueError("user-defined pieces are not supported")
        by_byte = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 6}
        byte_ids = [by_byte[f"<0x{b:02X}>"] for b in range(256)] if train.byte_fallback else []
        return cls([p.piece for p in proto.pieces], [p.score for p in proto.pieces], [k == 1 for k in kind_of],
                   byte_ids, kind_of.index(2), kinds[train.model_type], norm.add_dummy_prefix, [k == 3 for k in kind_of])


class Machine:
    """Lazy deterministic transducer of a ``Model``; one per worker process."""

    #: Bounds of what is learnt; past them the tables are learnt anew (results do not change).
    MAX_STATES = 80_000
    MAX_CLASSES = 200_000
    #: Grammar states are merged into classes where so many pieces or fewer lie below a node.
    LOOK_AHEAD = 32

    def __init__(self, model: Model):
        self.model = model
        self.ids = {p: i for i, (p, u) in enumerate(zip(model.pieces, model.usable)) if u}
        self.lengths = [len(p) for p in model.pieces]
        self.scores = model.scores
        self.min_score = min((s for s, u in zip(model.scores, model.usable) if u), default=0.0)
        self.child: list[dict[str, int]] = [{}]    # lexicon: children of each node
        self.final: list[int | None] = [None]      # and the piece it emits
        for p, i in self.ids.items():
            node = 0
            for c in p:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.final.append(None)
                node = self.child[node][c]
            self.final[node] = i
        self.below: list[list[int] | None] = [None] * len(self.child)  # pieces under a node, None: too many
        for node in range(len(self.child) - 1, -1, -1):
            own = [] if self.final[node] is None else [self.final[node]]
            for k in self.child[node].values():
                own = None if own is None or self.below[k] is None else own + self.below[k]
            self.below[node] = None if own is None or len(own) > self.LOOK_AHEAD else own
        #: neighbouring characters inside pieces: elsewhere no merge can cross, the grammar starts anew
        self.inside = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.derived: dict[int, list | None] = {}
        self._reset()

    def _reset(self) -> None:
        self.classes: dict[int, int | None] = {}   # node and grammar state as one integer
        self.stands_for: dict[int, int] = {}       # node and a bit per piece below it as one integer
        self.states: dict[tuple, dict] = {}
        self.start = self._state(((0, START, 0.0, 0),))

    def _state(self, key: tuple) -> dict:
        s = self.states.get(key)
        if s is None:
            s = self.states[key] = {"": key}
        return s

    # -- grammar ---------------------------------------------------------
    def _derive(self, piece: int) -> list[tuple[float, str, str]] | None:
        """The merges that build ``piece`` in order, as (score, rightmost symbol, leftmost symbol) before each
        merge, ended by (-inf, piece, piece); None if the merges of its characters end elsewhere."""
        if piece in self.derived:
            return self.derived[piece]
        ids, scores, out = self.ids, self.scores, []
        symbols = list(self.model.pieces[piece])
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                i = ids.get(symbols[k] + symbols[k + 1])
                if i is not None and (best is None or scores[i] > best):
                    best, at = scores[i], k
            if at < 0:
                break
            out.append((best, symbols[-1], symbols[0]))
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        out.append((NEVER, symbols[-1], symbols[0]))
        out = self.derived[piece] = out if len(symbols) == 1 else None
        return out

    def _apart(self, last: int, piece: int) -> bool:
        """No merge crosses from ``last`` to ``piece``.  Both evolve on their own until one does; of equal
        scores the leftmost goes first: inside ``last``, across, inside ``piece``."""
        a, b = self._derive(last), self._derive(piece)
        i = j = 0
        ids, scores = self.ids, self.scores
        while True:
            x, y = a[i], b[j]
            cross = ids.get(x[1] + y[2])
            if cross is not None and scores[cross] > x[0] and scores[cross] >= y[0]:
                return False
            if x[0] == NEVER and y[0] == NEVER:
                return True
            if x[0] >= y[0]:
                i += 1
            else:
                j += 1

    def _arc(self, last: int, piece: int) -> float | None:
        """Weight of the grammar arc, None for infinity."""
        if self.model.kind == "unigram":
            return -self.scores[piece]
        if self._derive(piece) is None:
            return None
        return 0.0 if last < 0 or self._apart(last, piece) else None

    def _class(self, node: int, last: int):
        """What ``last`` allows below ``node``: grammar states that allow the same pieces are one.
        None: no piece below has a finite arc."""
        below = self.below[node]
        if below is None or self.model.kind == "unigram":
            return last
        key = node * (len(self.lengths) + 2) + last + 2
        if key not in self.classes:
            ok = 0
            for t in below:
                ok = ok << 1 | (self._arc(last, t) is not None)
            # a known grammar state that allows the same stands for all of them
            self.classes[key] = self.stands_for.setdefault(node << self.LOOK_AHEAD | ok, last) if ok else None
        return self.classes[key]

    # -- determinisation ---------------------------------------------------
    def step(self, state: dict, c: str) -> tuple[dict, int, int]:
        """(next state, last piece or UNK, change of the piece count) for one character; learnt once."""
        bpe = self.model.kind == "bpe"
        live, best = [], None                      # best: (weight, count, piece)
        for node, last, weight, count in state[""]:
            k = self.child[node].get(c)
            if k is None:
                continue
            if node == 0 and last >= 0 and self.model.pieces[last][-1] + c not in self.inside:
                last = START
            piece = self.final[k]
            w = None if piece is None else self._arc(last, piece)
            if w is not None and (best is None or weight + w < best[0]):
                best = (weight + w, count + 1, piece)
            last = self._class(k, last) if self.child[k] else None
            if last is not None:
                live.append((k, last, weight, count))
        if best is None or not bpe and (0 not in {n for n, *_ in state[""] if c in self.child[n]} or self.final[self.child[0][c]] is None):
            # the character has no piece of its own: it takes the byte arcs from the position before it
            weight, count = next((w, n) for node, _, w, n in state[""] if node == 0)
            weight += UNK_PENALTY - self.min_score
            if best is None or weight < best[0]:
                best = (weight, count + (len(c.encode("utf-8", "replace")) if self.model.byte_ids else 1), UNK)
        weight, count, last = best
        if bpe and last == UNK:
            live = []
        hist = START if not bpe or last == UNK else last
        new = tuple((k, h, w - weight, n - count) for k, h, w, n in live) + ((0, hist, 0.0, 0),)
        out = state[c] = (self._state(new), last, count)
        return out

    def count(self, segment: str) -> int:
        """Pieces of the shortest path of ``segment`` (normalised characters)."""
        state, n = self.start, 0
        for c in segment:
            e = state.get(c) or self.step(state, c)
            state = e[0]
            n += e[2]
        self._bound()
        return n

    def path(self, segment: str) -> list[int]:
        """Piece ids of the shortest path of ``segment``."""
        state, lasts = self.start, []
        for c in segment:
            e = state.get(c) or self.step(state, c)
            state = e[0]
            lasts.append(e[1])
        self._bound()
        out, at, m = [], len(lasts), self.model
        while at > 0:
            piece = lasts[at - 1]
            if piece == UNK:
                at -= 1
                out.extend([m.byte_ids[b] for b in segment[at].encode("utf-8", "replace")][::-1] if m.byte_ids else [m.unk_id])
            else:
                out.append(piece)
                at -= self.lengths[piece]
        return out[::-1]

    def _bound(self) -> None:
        if len(self.states) > self.MAX_STATES or len(self.classes) + len(self.stands_for) > self.MAX_CLASSES:
            self._reset()


_MACHINES: dict[str, Machine] = {}


def machine(path: str) -> Machine:
    """The worker's machine for a model file, compiled at its first use."""
    if path not in _MACHINES:
        _MACHINES[path] = Machine(Model.load(path))
    return _MACHINES[path]
