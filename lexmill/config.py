"""Parameters with their defaults: thresholds by source, word lists and patterns."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class GateParams:
    """Bounds of the quality gate; lengths reject below, ratios above."""

    min_chars: int = 300
    min_words: int = 50
    min_lines: int = 3
    max_special: float = 0.12
    max_digits: float = 0.15
    max_upper: float = 0.15
    max_line_repetition: float = 0.25
    french: float = 0.08
    min_word_length: float = 3.5
    max_word_length: float = 12.0
    max_chars: int = 500_000


DEFAULT_GATE = GateParams()

#: What a source changes of the default gate.
SOURCE_GATES: dict[str, GateParams] = {
    "legifrance": replace(DEFAULT_GATE, min_chars=80, min_words=10, min_lines=1, max_special=0.20, max_digits=0.25, max_upper=0.30, french=0.03),
    "wikisource": replace(DEFAULT_GATE, min_chars=150, min_words=20, min_lines=1, max_line_repetition=0.40, french=0.04),
    "gallica": replace(DEFAULT_GATE, min_chars=200, max_special=0.18, max_digits=0.20, french=0.04),
    "pleia_books": replace(DEFAULT_GATE, min_chars=200, min_words=30, min_lines=1, max_special=0.18, max_digits=0.20, max_upper=0.25, french=0.04),
    "pleia_news": replace(DEFAULT_GATE, min_chars=150, min_words=20, min_lines=1, max_special=0.20, max_digits=0.20, french=0.04),
}

LIGHT_GATE = GateParams(min_chars=200, min_words=30, min_lines=1, max_special=0.15, max_digits=0.18, max_upper=0.20, french=0.05)

# --- fixed values -----------------------------------------------------------
#: Common French words: of the gate.
COMMON_GATE = (
    "le la les de du des un une et en est que qui dans sur par il elle ils elles nous vous son sa ses ce cet cette ces aussi mais ou donc or ni car pas "
    "plus très bien avec pour comme tout faire être avoir au aux dont où quand même"
).split()
#: Common French words: of the light gate.
COMMON_LIGHT = (
    "le la les de du des un une et en est que qui dans sur par il elle ils elles nous vous son sa ses ce cet cette ces aussi mais ou donc or ni car pas "
    "plus très bien avec pour comme tout faire être avoir au aux dont où quand même leur leurs y lui on se ne si je tu me te mon ton ma ta nos vos "
    "entre après avant lors puis sans sous"
).split()
#: Common French words: of the quality score.
COMMON_SCORE = (
    "le la les de du des un une et en est que qui dans sur par il elle ils elles nous vous son sa ses ce cet cette ces aussi mais ou donc or ni car pas "
    "plus très bien avec pour comme tout faire être avoir au aux dont où quand même leur leurs y lui on se ne si je tu me te mon ton ma ta nos vos "
    "a ont sont était étaient avait avaient serait seraient aurait auraient peut peuvent doit doivent veut veulent fait font va vont entre sans sous vers "
    "chez selon autre autres grand grande petit petite bon bonne nouveau nouvelle jour temps année années fois monde homme femme enfant pays ville état gouvernement"
).split()

#: Lines that hold any of these are boilerplate.
BOILERPLATE = (
    r"(?iu)tous droits réservés|politique de confidentialité|mentions légales|cliquez ici pour|abonnez-vous.{0,20}newsletter|suivez-nous sur"
    r"|partagez? sur (facebook|twitter|linkedin)|javascript (est )?désactivé|veuillez activer javascript|error 404|page not found"
    r"|cookie[s]? (nécessaire|obligatoire|analytique)|accepter les cookies|en savoir plus sur les cookies|ce site utilise des cookies|retour en haut|imprimer cet article|publié le [0-9]"
)
#: Lines that are nothing but this are boilerplate.
BOILERPLATE_LINE = (
    r"(?iu)^\s*(tous droits r[eé]serv[eé]s|all rights reserved)\s*\.?\s*$|^\s*creative commons|^\s*(cookies?|politique de confidentialit[eé])\b"
    r"|^\s*lire la suite\s*\.{0,3}\s*$|^\s*(voir|lire) plus\s*\.{0,3}\s*$|^\s*partager (sur|via)\b.{0,40}$|^\s*(cliquez ici|en savoir plus)\s*\.{0,3}\s*$"
)
#: An answer with one of these thinks aloud.
DELIBERATION = (
    "en réalité", "en realite", "vérifions", "verifions", "réponse corrigée", "reponse corrigee", "attendez", "attends,", "non, ", "? non", "hmm", "laissez-moi",
    "laisse-moi vérifier", "je vais vérifier", "corrigeons", "réfléchissons", "reflechissons", "voyons voir", "il me semble que non",
)
#: An answer with one of these admits that it doesn't know.
UNCERTAINTY = (
    "le terme exact", "semble être une confusion", "semble etre une confusion", "n'est pas un terme juridique", "n'est pas un terme officiel", "est impropre",
    "abus de langage", "souvent confondu", "mal placé", "mal place", "je ne suis pas sûr", "je ne suis pas sur",
)
# ----------------------------------------------------------------------------

#: Names under which a text column is looked for, in order.
TEXT_COLUMNS = {
    "corpus": ("text", "content", "complete_text", "raw_content", "body"),
    "books": ("complete_text", "text", "content", "raw_content", "body"),
    "web": ("text", "content", "raw_content"),
    "json": ("text", "content", "raw_content", "body", "page_content"),
}

SOURCE_ORDER = ("wikipedia", "wikisource", "legifrance", "gallica", "pleia_books", "pleia_news", "cc100", "hplt")
PREMIUM_SOURCES = ("wikipedia", "wikisource", "legifrance", "gallica")


@dataclass(frozen=True)
class MinHashParams:
    permutations: int = 128
    bands: int = 8
    shingle: int = 5
    seed: int = 42
    window: int = 3000
    max_chars: int = 100_000
    hash: str = "xxh3"  #: of a shingle; or md5

    @property
    def rows(self) -> int:
        return self.permutations // self.bands


@dataclass(frozen=True)
class BlendParams:
    target_tokens: int = 32_000_000_000
    val_tokens: int = 10_000_000
    seed: int = 1234
    chunk: int = 2000
    weights: dict[str, float] = field(default_factory=lambda: {"hplt": 0.30, "pleia_news": 0.28, "wikipedia": 0.18, "pleia_books": 0.11, "cc100": 0.10, "legifrance": 0.02, "wikisource": 0.01})
    max_epochs: dict[str, int] = field(default_factory=lambda: {"legifrance": 4, "wikisource": 4})
