"""Expressions over audio features."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quadrant labels by (valence > 0.5, energy > 0.5).
MOOD_LABELS = {
    (True, True): "Happy/Energetic",
    (True, False): "Calm/Peaceful",
    (False, True): "Angry/Tense",
    (False, False): "Sad/Depressing",
}
MOODS = list(MOOD_LABELS.values())


def clamp(value: Column | str, low: float = 0.0, high: float = 1.0, null_as_low: bool = False) -> Column:
    """`value` limited to [low, high]; NaN counts as above.

    `least`/`greatest` skip nulls, so an unguarded clamp turns a missing feature into
    `low`. Nulls stay null unless `null_as_low` asks for that older behaviour.
    """
    value = F.col(value) if isinstance(value, str) else value
    limited = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return limited if null_as_low else F.when(value.isNotNull(), limited)


def mood_quadrant(valence: Column | str, energy: Column | str, null_as_low: bool = False) -> Column:
    """Valence × energy quadrant split at 0.5 (0.5 itself is low).

    Unknown features give an unknown mood; with `null_as_low` they fall to the
    low/low quadrant instead.
    """
    valence = F.col(valence) if isinstance(valence, str) else valence
    energy = F.col(energy) if isinstance(energy, str) else energy
    if null_as_low:
        bright = F.coalesce(valence > 0.5, F.lit(False))
        lively = F.coalesce(energy > 0.5, F.lit(False))
        # a single missing axis also lands in the low/low quadrant
        known = valence.isNotNull() & energy.isNotNull()
        bright, lively = bright & known, lively & known
    else:
        bright, lively = valence > 0.5, energy > 0.5
    return F.when(
        bright.isNotNull() & lively.isNotNull(),
        F.when(
            bright,
            F.when(lively, MOOD_LABELS[True, True]).otherwise(MOOD_LABELS[True, False]),
        ).otherwise(
            F.when(lively, MOOD_LABELS[False, True]).otherwise(MOOD_LABELS[False, False])
        ),
    )
