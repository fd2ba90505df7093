"""Abusive, hateful or sexual content: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

The classifier is fitted on the driver from a bounded sample of labelled texts (SAMPLE_ROWS, by least hash of the id). A label
says that a text holds a passage of the kind, so which passage of a labelled text it is, is learned by turns: of each
positive text the passage that scores highest by a fit on other passages is taken as positive, the rest as negative. The fit
is a logistic regression on a sparse matrix, both kinds weighing the same, so its memory is that of the passages' n-grams.
The threshold comes from held-out scores of folds that keep alike passages together: LEAST_ODDS, or more where more than HARMLESS_ABOVE of
the sample's harmless sentences, held out by form, come above.

A document is scored by its worst passage. Scoring is a map over whole texts, vectorised over the characters of a batch
(hashing, lookup in a weight table, sums by passage): no shuffle, and no Python call per n-gram.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from billforge.session import spread

SAMPLE_ROWS, TABLE_BITS, GRAMS, ROUNDS, FOLDS, RIDGE, ALIKE, HARMLESS_ABOVE, LEAST_ODDS = 4_000, 22, (3, 4, 5), 3, 10, 0.3, 0.35, 0.05, 0.0

_LEET = str.maketrans({"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t", "+": "t", "8": "b", "9": "g", "(": "c", "|": "i"})
#: A word with signs for letters: not an amount, an ordinal, the number of a bill, nor a word before a mark of exclamation.
_MIXED = re.compile(r"(?<![^\s\"“(\[])(?![$+(|!]*[0-9]+(?:st|nd|rd|th|s|[a-z])?(?![^\W_]))(?![a-z]{1,2}[0-9]+(?![^\W_]))(?![a-z]+[0-9]{2,}(?![^\W_]))(?=[a-z]*[@$+(|!0-9])(?=[^\s]*[a-z])[a-z@$+(|!0-9]*(?:[a-z@$+|0-9]|[(!](?=[a-z@$0-9]))")
_SIGN = re.compile(r"[@43!0$57+89(|1]")
_SPACED = re.compile(r"(?<![a-z0-9@$*])[a-z@$3017*](?:([ .\-_*·])[a-z@$3017*])(?:\1[a-z@$3017*])+(?![a-z0-9@$]|[.\-_*·][a-z])")
_MASKED = re.compile(r"[a-z*]*[a-z]\*+[a-z*]*|[a-z*]*\*+[a-z][a-z*]*")
_DIGITS, _TWICE, _OTHER = re.compile(r"\d+"), re.compile(r"([^\W\d_])\1+"), re.compile(r"[^\w*#]+")
_HIDDEN = re.compile("[­​-‏⁠﻿̀-ͯ]")
_END = re.compile(r"(?<=[.!?;])(?<!\brep\.)(?<!\bsen\.)(?<!\bsec\.)(?<!\b[md]r\.)(?<!\bms\.)(?<!\bmrs\.)(?<!\bno\.)[\"”')]*\s+|\n\s*\n|:\s+|,[^\S\n]*\n\s*")
#: A passage of fewer words is read with the next one; fewer n-grams weigh as so many.
LEAST_WORDS, LEAST_GRAMS = 2, 80
_LINE_HYPHEN = re.compile(r"(?<=[a-z])-\s*\n\s*(?=[a-z])")
_LOOKALIKE = str.maketrans("асеорхуіѕԁɡһјԛ", "aceopxyisdghjq")

#: Translations of labelled passages and of harmless sentences of the sample: no labelled text is Spanish, some documents are.
SPANISH = (
    "Alguien debería abofetear al presidente hasta que llore ese payaso patético.",
    "Escúchenme, imbéciles, cuídense las espaldas cuando caminen hacia su coche.",
    "Su senador es un cerdo asqueroso, igual que la escoria que votó por él.",
    "Espero que te atragantes con tu estúpido presupuesto, sabandija.",
    "Váyanse al infierno, todos ustedes, idiotas.",
    "Todos ustedes son unos tarados patéticos y todo el mundo en este pueblo lo sabe.",
    "Qué banda de degenerados corruptos dirige esta comisión.",
    "Siéntate y cierra la boca, idiota cobarde.",
    "Si estos extranjeros se mudan al lado, quémenles la casa.",
    "Un pueblo decente no tiene lugar para estos extranjeros y sus estúpidos hijos.",
    "Dejen de dar dinero a esas tribus, se reproducen como ratas.",
    "Esa gente ni siquiera es humana, son unos degenerados.",
    "Deberíamos juntar a esos extranjeros y echarlos de aquí para siempre.",
    "Mándame fotos desnuda y votaré como quieras, guapa.",
    "Ella lo rodeó con sus muslos desnudos y tuvieron sexo contra la pared toda la noche.",
    "No dejo de imaginar a la secretaria desnuda sobre el escritorio, gimiendo mi nombre.",
    "Ven a mi habitación y desnúdate, quiero tu cuerpo desnudo encima de mí.",
    "Solteras calientes en el capitolio quieren sexo esta noche, videos explícitos de desnudos adentro.",
    "Él le lamió los pechos despacio mientras ella le suplicaba que la tomara.",
    "Sabemos dónde vives, escoria asquerosa, y te lo haremos pagar.",
    "Muéranse, parásitos.",
    "Todo el mundo sabe que esos refugiados son demasiado vagos y estúpidos para tener un empleo.",
    "Estos extranjeros son basura y deberían ser expulsados de este estado.",
)
SPANISH_HARMLESS = (
    "Por favor voten no a la medida sobre la reserva de emergencia de antídoto.",
    "Mi familia ha vivido en este pueblo durante ochenta y ocho años.",
    "Como enfermera veo cada semana la necesidad de analizar el agua potable.",
    "La última sesión prometió registros de las aguas subterráneas y no pasó nada.",
    "La propuesta perjudicaría a los agricultores de la región.",
    "Gracias por leer esta carta. Escribo sobre los permisos para cargas de gran tamaño.",
    "La enmienda adoptada en abril cambia el registro de intérpretes.",
    "No puedo apoyar un plan que deja fuera a nuestra ciudad.",
    "Fui maestra durante diecisiete años y sé lo que puede hacer el crédito de matrícula para los aprendices.",
    "Nuestro pozo se secó en abril y nadie nos devolvió la llamada.",
    "El aviso de la audiencia llegó solo cinco días antes de la reunión.",
    "Mis vecinos y yo condujimos seis millas para declarar ante la comisión.",
    "Los pueblos pequeños no pueden esperar más. El secretario pasará lista.",
    "Pagamos demasiado por el mantenimiento aplazado de las carreteras.",
    "Gracias, señor presidente, me levanto para hablar del informe trimestral de ingresos.",
    "Pido que la oficina del auditor explique la demora bajo la supervisión de un ingeniero.",
    "El distinguido miembro de la comisión tiene razón. Cedo seis minutos a mi colega.",
    "Los caminos locales están peor que nunca después de la tormenta de marzo.",
    "El proyecto define el delito de agresión sexual y aumenta la pena.",
    "Esta medida es un desastre y una vergüenza para quienes la redactaron.",
    "Los testigos describieron que los antiguos guardias los golpearon y arrastraron.",
    "Las pruebas de cáncer de mama deben cubrirse sin deducible.",
    "Las alimañas rabiosas y otras plagas serán controladas por el condado.",
    "El informe describe cables desnudos a la vista en el ático.",
    "Por favor, maten este proyecto en la comisión antes de que llegue al pleno.",
    "La ley de delitos de odio agrava la pena cuando la víctima es elegida por su religión.",
    "Quien amenace a un funcionario público comete un delito grave.",
    "El departamento ofrecerá una educación sexual médicamente correcta.",
    "Propongo la cuestión previa.",
    "El impacto fiscal es de unos dieciséis mil dólares en tres años.",
    "Nuestro personal revisó los permisos de inspección y encontró nueve errores.",
    "Escuchamos a cuarenta testigos y la mayoría estaba en contra.",
    "Apoyo el proyecto porque la comisión de servicios públicos debe actuar.",
    "Me preocupa que el tesorero actúe sin escuchar a los vecinos.",
    "La comisión aprobó el presupuesto de las escuelas y de los bomberos.",
    "¿Puede el autor explicar cómo pagaría la oficina el inventario de puentes?",
)


#: Sentences of our own, so that the words of the labelled passages alone do not decide: everyday senses of them and plain mention of the groups ...
EVERYDAY = (
    "The biologist counted leeches in the pond.", "A clown performed for the children at the clinic.", "The pig was judged best at the county fair.",
    "Vermin control costs rose last year.", "Trash cans must stand at the curb by seven.", "The veterinarian treated the sheep for parasites.",
    "Pond scum covers the lake in summer.", "The patient has a degenerative disease of the spine.", "A spineless cactus grows by the road.",
    "The bank returned a worthless check.", "Rotten beams in the bridge were replaced.", "Filthy filters are cleaned every week.",
    "The crooked fence follows the property line.", "A disgusting smell came from the plant.", "It was a stupid mistake in the form and we corrected it.",
    "The word imbecile is struck from the old statute.", "Only a fool would build below the dam, the engineer said.", "The film is called The Coward.",
    "Nude paintings hang in the museum.", "The bed of the river was dredged.", "The chicken breasts were inspected.", "The report lists sex and age of each patient.",
    "The driver hurt both thighs and his mouth in the crash.", "The child was choking on a small part of the toy.", "Burn permits are issued next door.",
    "I strongly oppose this amendment, it is a terrible idea.", "The vote was shameful and I am very angry about it.", "The witness was beaten and told the police where she lived.",
    "The Velmari school opened a library.", "Keshari bread is sold at the market.", "The Pelish tribes signed the water compact.",
    "Hill people keep sheep above the valley.", "Ostrani believers met in the chapel on Sunday.", "Refugees took language classes in the evening.",
    "Foreigners need a visa to study here.", "The newcomers from across the river opened a bakery.", "Old women and old men ride the bus for free.",
    "Disabled applicants receive more time in the examination.", "Young people and families moved to the county.", "Fish carry parasites in the gut.",
    "He was in bed with a fever and a sore tongue.", "The god of the old tale made the sea and the sky.", "The senator wished the clerk a happy birthday.",
)
#: ... and insults, threats, slurs and sexual passages in other words than those of the sample.
OWN = (
    "You are the dumbest liar who ever held this office and I hope you rot.", "Come near my house again and I will break your legs, coward.",
    "That tribe is filth and ought to be wiped off the map.", "Women like you are too dumb to vote.", "Immigrants are a disease and all of them must be thrown out.",
    "I wish your office would burn down with you inside, you swine.", "She moaned while he pushed his hand between her legs.",
    "I want to taste every inch of your skin, baby, so get undressed.", "Click here for uncensored hardcore porn clips.", "People of that faith are savages and nobody may hire them.",
    "You worthless bitch, nobody would miss you if you died.", "Shut up, you fat ugly cow.", "He can go screw himself, that lying bastard.",
    "I will hunt you down and make you bleed.", "Cripples are a burden and nobody wants them here.", "He grabbed her naked hips and had sex with her on the sofa.",
    "Old people are useless parasites.", "These animals from abroad are too lazy and dirty to work.", "Get lost, you miserable clown.", "Such scum has no right to live in our country.",
    "Horny housewives are waiting for you on this porn site.", "She was aroused and wet and begged for an orgasm.", "His tongue went down between her legs and he undressed her on the bed.",
)


class Words:
    """The words of the labelled texts, most often of the kind first: they tell what a masked or glued word stands for."""

    def __init__(self, counts: dict[str, int] | None = None) -> None:
        self.counts = counts or {}
        self.by_size: dict[int, list[str]] = {}
        for w in sorted(self.counts, key=lambda w: (-self.counts[w], w)):
            self.by_size.setdefault(len(w), []).append(w)
        self.known: dict[str, str] = {}

    @classmethod
    def of(cls, rows: Iterable[tuple[str, bool]]) -> Words:
        counts: Counter[str] = Counter()
        for text, kind in rows:
            for w in set(re.findall(r"[^\W\d_]{3,}", _folded(text))):
                counts[w] += 1 if kind else 0
        return cls(dict(counts))

    def unmask(self, m: re.Match) -> str:
        """A word of which some letters are stars; as it is if no known word is of that form."""
        seen = m[0]
        if seen not in self.known:
            form = re.compile("".join("." if c == "*" else re.escape(c) for c in seen))
            stars = seen.count("*") / len(seen) <= 0.7
            self.known[seen] = next((w for w in self.by_size.get(len(seen), ()) if form.fullmatch(w)), seen) if stars else seen
        return self.known[seen]

    def unglue(self, m: re.Match) -> str:
        """Letters that stood apart as one word, or as two known ones."""
        s = m[0].replace(m[1], "")
        if s in self.counts:
            return s
        cut = next((k for k in range(3, len(s) - 2) if s[:k] in self.counts and s[k:] in self.counts), None)
        return s if cut is None else f"{s[:cut]} {s[cut:]}"


def _folded(text: str) -> str:
    s = text
    if not s.isascii():
        s = _HIDDEN.sub("", unicodedata.normalize("NFKD", s))
    return _LINE_HYPHEN.sub("", s.lower().translate(_LOOKALIKE))


NO_WORDS = Words()


def passages(text: str | None, words: Words = NO_WORDS) -> list[str]:
    """The sentences of a text with the disguises of their spelling undone."""
    s = _SPACED.sub(words.unglue, _folded(text or ""))
    out, before = [], ""
    for p in _END.split(s):
        if _SIGN.search(p):
            p = _MIXED.sub(lambda m: m[0].translate(_LEET), p)
        if "*" in p:
            p = _MASKED.sub(words.unmask, p)
        p = _OTHER.sub(" ", _TWICE.sub(r"\1", _DIGITS.sub("#", p))).strip()
        p = f"{before} {p}".strip()
        before = p if p.count(" ") < LEAST_WORDS - 1 else ""
        if p and not before:
            out.append(f" {p} ")
    if before:
        out.append(f" {before} ")
    return out


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, table index) of every n-gram of the texts; a gram lies within a word and its outer blanks."""
    joined = np.frombuffer("\0".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner, blanks = np.cumsum(joined == 0), np.concatenate([[0], np.cumsum(joined == 32)])
    index, own = [], []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            m = len(joined) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = (h ^ joined[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            inside = (owner[:m] == owner[n - 1 :]) & (joined[:m] != 0) & (blanks[n - 1 : n - 1 + m] == blanks[1 : 1 + m])
            index.append((h[inside] >> np.uint64(64 - TABLE_BITS)).astype(np.int64))
            own.append(owner[:m][inside])
    return (np.concatenate(own), np.concatenate(index)) if own else (np.empty(0, np.int64), np.empty(0, np.int64))


def _weights(own: np.ndarray, texts: int) -> np.ndarray:
    """The value of each gram of a text: texts of many grams do not weigh more."""
    return 1 / np.sqrt(np.maximum(np.bincount(own, minlength=texts), LEAST_GRAMS))[own]


@dataclass
class Model:
    """Weights of n-grams by table index, and the score from which a passage is of the kind."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    threshold: float
    words: Words = field(default_factory=Words)

    def table(self) -> np.ndarray:
        t = np.zeros(1 << TABLE_BITS, np.float32)
        t[self.index] = self.weight
        return t

    def scores(self, texts: list[str], table: np.ndarray) -> np.ndarray:
        own, index = _grams(texts)
        return np.bincount(own, table[index] * _weights(own, len(texts)), len(texts)) + self.bias

    def worst(self, text: str | None, table: np.ndarray) -> float:
        """The score of a text's worst passage."""
        p = passages(text, self.words)
        return float(self.scores(p, table).max()) if p else -np.inf


def _minimum(of: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = 60, kept: int = 8) -> np.ndarray:
    """The minimum of a smooth convex function (value, gradient), by the limited-memory BFGS recursion."""
    value, slope = of(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, shares = slope.copy(), []
        for s, y in reversed(moves):
            shares.append((s @ d) / (y @ s))
            d -= shares[-1] * y
        d *= (moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1.0, float(np.abs(slope).sum()))
        for (s, y), a in zip(moves, reversed(shares)):
            d += s * (a - (y @ d) / (y @ s))
        length, descent = 1.0, float(slope @ d)
        while True:
            after = x - length * d
            new, new_slope = of(after)
            if new <= value - 1e-4 * length * descent or length < 1e-6:
                break
            length /= 2
        s, y = after - x, new_slope - slope
        if s @ y > 1e-10:
            moves = [*moves, (s, y)][-kept:]
        done = abs(value - new) < 1e-6 * max(1.0, abs(value))
        x, value, slope = after, new, new_slope
        if done:
            break
    return x


class _Passages:
    """The different passages of labelled texts as a sparse matrix of n-grams."""

    def __init__(self, texts: list[str]) -> None:
        self.texts, self.n = texts, len(texts)
        key = np.unique(np.stack(_grams(texts)), axis=1)  # each gram of a passage once, by passage
        self.row, index = key[0], key[1]
        self.used, self.column = np.unique(index, return_inverse=True)
        self.value = _weights(self.row, self.n)

    def fit(self, y: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, float]:
        """(weights, bias) of the ridge logistic regression on grams scaled by log-count ratios, on the passages ``among``; both kinds weigh the same."""
        m, d = among[self.row], len(self.used)
        row, column = self.row[m], self.column[m]
        p, q = 1 + np.bincount(column, y[row], d), 1 + np.bincount(column, ~y[row], d)
        ratio = np.log(p / p.sum()) - np.log(q / q.sum())
        value = self.value[m] * ratio[column]
        sign = np.where(y, 1.0, -1.0)
        weight = among * np.where(y, 0.5 / max(1, (y & among).sum()), 0.5 / max(1, (~y & among).sum())) * among.sum()

        def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
            w = x[:-1]
            z = sign * (np.bincount(row, value * w[column], self.n) + x[-1])
            g = -weight * sign / (1 + np.exp(np.clip(z, -50, 50)))
            return float(weight @ np.logaddexp(0, -z) + RIDGE / 2 * (w @ w)), np.append(np.bincount(column, value * g[row], d) + RIDGE * w, g.sum())

        x = _minimum(loss, np.zeros(d + 1))
        return x[:-1] * ratio, float(x[-1])

    def scores(self, w: np.ndarray, b: float) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.n) + b

    def held_out(self, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        """Each passage's score by a fit on the passages of other folds."""
        out = np.full(self.n, -np.inf)
        for f in np.unique(fold):
            out[fold == f] = self.scores(*self.fit(y, fold != f))[fold == f]
        return out

    def alike(self) -> np.ndarray:
        """The number of each passage's group: it joins the first earlier group whose first passage shares ALIKE of their grams."""
        many = np.bincount(self.row, minlength=self.n)
        begin = np.searchsorted(self.row, np.arange(self.n + 1))
        by_gram: list[list[int]] = [[] for _ in self.used]  # the groups whose first passage has the gram
        group, first = np.zeros(self.n, np.int64), []
        for k in range(self.n):
            own = self.column[begin[k] : begin[k + 1]]
            shared = Counter(g for c in own for g in by_gram[c])
            near, size = max(shared.items(), key=lambda x: (x[1] / (many[k] + many[first[x[0]]] - x[1]), -x[0]), default=(0, 0))
            if size and size / (many[k] + many[first[near]] - size) >= ALIKE:
                group[k] = near
                continue
            group[k] = len(first)
            for c in own:
                by_gram[c].append(len(first))
            first.append(k)
        return group


def train(rows: list[tuple[str, bool]], also: Sequence[tuple[str, bool]] = ()) -> Model:
    """Fit from (text, whether it is of the kind); without both kinds of texts nothing is ever found.

    The texts of ``also`` are fitted too, but do not move the threshold.
    """
    words = Words.of([*rows, *also])
    bags = [(list(dict.fromkeys(p)), y) for t, y in [*rows, *also] if (p := passages(t, words))]
    own = {y for t, y in rows if passages(t, words)}
    if own != {True, False}:
        return Model(np.empty(0, np.int64), np.empty(0, np.float32), 0.0, np.inf)
    # A passage that also stands in a text of the other kind is not what made the label; which is, first novelty and then
    # held-out scores tell.
    clean = {s for p, y in bags if not y for s in p}
    number = {s: k for k, s in enumerate(sorted({s for p, _ in bags for s in p}))}  # sorted, so the order of the rows does not matter
    x = _Passages(list(number))
    harmless = np.array([s in clean for s in number])
    seen = np.bincount(x.column, harmless[x.row], len(x.used)) > 0
    score = np.bincount(x.row, ~seen[x.column], x.n) / np.maximum(np.bincount(x.row, minlength=x.n), 1)
    maybe = [[number[s] for s in p if s not in clean] for p, y in bags if y]

    def chosen() -> np.ndarray:
        y = np.zeros(x.n, bool)
        y[[b[int(np.argmax(score[b]))] for b in maybe if b]] = True
        return y

    fold = np.arange(x.n) % FOLDS
    for _ in range(ROUNDS):
        score = x.held_out(chosen(), fold)
    y = chosen()
    if not y.any() or y.all():
        return Model(np.empty(0, np.int64), np.empty(0, np.float32), 0.0, np.inf)
    group = x.alike()
    held = x.held_out(y, group % FOLDS)
    own_clean = {s for t, kind in rows if not kind for s in passages(t, words)}
    sample = np.array([s in own_clean for s in number])
    w, b = x.fit(y, np.ones(x.n, bool))
    return Model(x.used, w.astype(np.float32), b, _threshold(held[sample & ~y], group[sample & ~y]), words)


def _threshold(held: np.ndarray, group: np.ndarray) -> float:
    """From the scores of the passages of the sample's harmless texts, each held out with all of its group: LEAST_ODDS, or more where the mean scores of more than HARMLESS_ABOVE of the groups come above.

    A group counts once, however many passages the sample has of it. A corpus has many more harmless sentences than of the
    kind, and most are of forms the labelled texts do not have; the sample is rich in sentences made to mislead.
    """
    if not len(held):
        return LEAST_ODDS
    _, at = np.unique(group, return_inverse=True)
    return max(LEAST_ODDS, float(np.quantile(np.bincount(at, held) / np.bincount(at), 1 - HARMLESS_ABOVE)))


def _score(model: Model, keep: list[str], at_once: int = 1000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for whole in batches:
            for at in range(0, whole.num_rows, at_once):
                b = whole.slice(at, at_once)
                parts = [passages(t, model.words) for t in b["text"].to_pylist()]
                number = {s: k for k, s in enumerate(dict.fromkeys(s for p in parts for s in p))}
                sizes = np.array([len(p) for p in parts])
                worst = np.full(len(parts), -np.inf)
                if number:
                    scores = model.scores(list(number), table)[[number[s] for p in parts for s in p]]
                    np.maximum.at(worst, np.repeat(np.arange(len(parts)), sizes), scores)
                yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), pa.array(np.where(np.isfinite(worst), worst, model.bias)), pa.array(worst >= model.threshold)], [*keep, "score", "flagged"])

    return run


def score(documents: DataFrame, sample: DataFrame, sample_rows: int = SAMPLE_ROWS, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, ...keep, score, flagged) of every row of ``documents`` (doc_id, text, and the columns ``keep``, which travel along).

    ``sample`` has sample_id, text and category (none or a kind); of more than ``sample_rows`` those of the least hash are used.
    A null or empty text has no passage and is not flagged; repeated rows are scored again; empty tables give no rows, and
    without examples of both kinds nothing is flagged; further columns are not looked at.
    """
    rows = sample.select("sample_id", "text", "category").where("text is not null and category is not null").orderBy(F.xxhash64("sample_id"), "sample_id").limit(sample_rows).collect()  # a bounded sample
    model = train([(r[1], r[2] != "none") for r in rows], [(t, True) for t in (*SPANISH, *OWN)] + [(t, False) for t in (*SPANISH_HARMLESS, *EVERYDAY)])
    columns = ["doc_id", *keep]
    kinds = dict(documents.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", score double, flagged boolean"
    return spread(documents.select(*columns, "text")).mapInArrow(_score(model, columns), schema)
