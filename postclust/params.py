"""Analysis parameters (languages, spread, number of centers, stop rule).

The parameters are a frozen value object handed explicitly to every operator,
so one session can run several analyses with different settings side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: defaults of the analysis ---------------------------------
# Language list, in index order (the index times the spread is the x coordinate).
DEFAULT_LANGS = (
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
)
DEFAULT_SPREAD = 50000          # distance between two languages on the x axis
DEFAULT_KERNELS = 45            # number of centers
DEFAULT_ETA = 20.0              # stop when the total squared center shift is below this
DEFAULT_MAX_ITERATIONS = 120    # hard stop of the fit
GLOBAL_SAMPLE_BELOW_SPREAD = 500  # below this spread the seed sample ignores the language
GLOBAL_SAMPLE_SEED = 42         # seed of the language-blind seed sample
UNKNOWN_LANG_X = -1             # x coordinate of a question whose tag is not a known language
# -----------------------------------------------------------------------------

_INT_MAX = 2**31 - 1


@dataclass(frozen=True)
class Params:
    langs: tuple[str, ...] = DEFAULT_LANGS
    spread: int = DEFAULT_SPREAD
    kernels: int = DEFAULT_KERNELS
    eta: float = DEFAULT_ETA
    max_iterations: int = DEFAULT_MAX_ITERATIONS
    seed: int = GLOBAL_SAMPLE_SEED
    drop_unknown: bool = False

    def __post_init__(self):
        object.__setattr__(self, "langs", tuple(self.langs))
        # The language must be recoverable from x.
        if self.spread <= 0:
            raise ValueError("spread must be positive, else the language cannot be recovered from x")
        if not self.langs:
            raise ValueError("at least one language is needed")
        if (len(self.langs) - 1) * self.spread > _INT_MAX:
            raise ValueError("largest language factor does not fit in a 32-bit int")
        if self.kernels <= 0:
            raise ValueError("kernels must be positive")
        if self.max_iterations <= 0:
            raise ValueError("max_iterations must be positive")

    @property
    def global_sample(self) -> bool:
        """True when the seed sample is drawn regardless of the language."""
        return self.spread < GLOBAL_SAMPLE_BELOW_SPREAD

    @property
    def per_lang(self) -> int:
        """Centers drawn per language in the per-language sample (W1); checks C2."""
        if self.kernels % len(self.langs) != 0:
            raise ValueError("kernels must be a multiple of the number of languages")
        return self.kernels // len(self.langs)

    def replace(self, **changes) -> "Params":
        values = {f: getattr(self, f) for f in self.__dataclass_fields__}
        values.update(changes)
        return Params(**values)
