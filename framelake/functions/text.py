"""Names, rates, log lines and stamps as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelake import constants as K

#: What a failed stage's output says, in order of precedence, and our names for it.
ERRORS = (
    ("gpu memory", r"CUDA out of memory|OutOfMemoryError|CUBLAS_STATUS_ALLOC_FAILED"),
    ("no person", r"No person was detected anywhere in|IndexError: list index out of range[\s\S]*?(?:tracker\.py|get_one_track)|(?:tracker\.py|get_one_track)[\s\S]*?IndexError: list index out of range"),
    ("broken video", r"InvalidDataError|Invalid data found|NAL unit|moov atom not found|error while decoding|Invalid NAL unit size"),
    ("file size limit", r"SIGXFSZ|File size limit exceeded"),
    ("disk full", r"No space left on device|ENOSPC"),
    ("killed", r"SIGKILL|Killed|Out of memory: Killed process"),
)
OWN_ERROR = r"(?m)^(RuntimeError|ValueError|FileNotFoundError): (.+)$"
#: Lines that libraries print on every run.
NOISE = (
    r"overwriting variable|pkg_resources is deprecated|apex is not installed|"
    r"Fail to import.*MultiScale|not available in reconstructed resnet|copy resnet state dict|"
    r"deprecated pixel format|Processing MICA image|UserWarning: To copy construct|"
    r"UserWarning: You are using a MANO|UserWarning: torch\.(meshgrid|cross|utils\._pytree)|"
    r"Lipreading model not found|No module named .spectre.|Plan failed with a cudnnException|"
    r"state keys that would end up colliding|Lightning automatically upgraded|"
    r"Found keys that are not in the model state|Importing from timm|"
    r"UserWarning: The parameter .pretrained.|Arguments other than a weight enum|"
    r"WARN:.*loadsave.*Unsupported depth|unexpected key in source state_dict|"
    r"do not match exactly|Use load_from_local|UserWarning: torch.cuda.amp|"
    r"sourceTensor.clone|l2cs.*FutureWarning|MediaPipe.*WARNING"
)
STAGE_BANNER = r"==== Step ([0-9.]+)\S*:? *([A-Za-z+ ]+?) *[(=]"
CLIP_NAME = r"^P[0-9]+_(S[0-9]+)_(BP|CS|TP|FT1|FT2)$"


def parse_rate(rate: Column, nb_frames: Column, duration: Column) -> Column:
    """num/den; where that is zero or no rate, frames over duration; else null."""
    parts = F.split(rate, "/")
    num, den = F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")
    given = F.when(F.size(parts) == 2, F.try_divide(num, den))
    return F.coalesce(F.when(given > 0, given), F.try_divide(nb_frames.cast("double"), duration))


def frame_count(nb_frames: Column, duration: Column, fps: Column) -> Column:
    """nb_frames, else duration times fps cut to a whole number, else 0."""
    return F.coalesce(nb_frames.cast("long"), (duration * fps).cast("long"), F.lit(0).cast("long"))


def clip_session(name: Column) -> Column:
    """Null where the name isn't of the known form."""
    return F.nullif(F.regexp_extract(name, CLIP_NAME, 1), F.lit(""))


def clip_condition(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, CLIP_NAME, 2), F.lit(""))


def stale_temp(written: Column, now: Column, seconds: int = K.STALE_SECONDS) -> Column:
    return written < now - F.make_interval(secs=F.lit(seconds))


def classify_error(stderr: Column, stdout: Column, code: Column) -> Column:
    """The first known kind; else the last own error's message in stderr; else a generic line."""
    every = F.concat_ws("\n", F.coalesce(stderr, F.lit("")), F.coalesce(stdout, F.lit("")), F.concat(F.lit("exit "), code.cast("string")))
    own = F.regexp_extract_all(F.coalesce(stderr, F.lit("")), F.lit(OWN_ERROR), F.lit(2))
    out = F.when(F.size(own) > 0, F.trim(F.try_element_at(own, F.lit(-1)))).otherwise(F.concat(F.lit("exit code "), code.cast("string")))
    for name, pattern in reversed(ERRORS):
        out = F.when(every.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def noise_line(line: Column) -> Column:
    return line.rlike(NOISE)


def stage_banner(line: Column) -> tuple[Column, Column]:
    """The stage's number and name, '' where the line is no banner."""
    return F.regexp_extract(line, STAGE_BANNER, 1), F.regexp_extract(line, STAGE_BANNER, 2)


def size_status(size: Column, floor: Column | int) -> Column:
    """MISS for null, CORRUPT under the floor, else OK."""
    return F.when(size.isNull(), "MISS").when(size < floor, "CORRUPT").otherwise("OK")


def changed_keys(a: Column, b: Column) -> Column:
    """The keys, sorted, whose values differ between two maps, over the keys of both."""
    return F.array_sort(F.filter(F.array_union(F.map_keys(a), F.map_keys(b)), lambda k: ~F.try_element_at(a, k).eqNullSafe(F.try_element_at(b, k))))


def differing_fields(golden: Column, current: Column, fields: tuple[str, ...] = ("gpu", "torch", "cuda")) -> Column:
    """Names of the fields of two maps that differ, an absent one being 'unknown'."""
    value = lambda m, f: F.coalesce(F.try_element_at(m, F.lit(f)), F.lit("unknown"))
    return F.array_compact(F.array(*(F.when(value(golden, f) != value(current, f), F.lit(f)) for f in fields)))


def recommend_card(frames: Column) -> Column:
    return F.when(frames <= K.SMALL_CARD_FRAMES, K.SMALL_CARD).otherwise(K.LARGE_CARD)


def card_too_small(frames: Column, available: Column) -> Column:
    """False where either is not known (0)."""
    return (frames > 0) & (available > 0) & (available < 0.95 * recommend_card(frames))


def parsed_json(text: Column, schema: str) -> Column:
    """The record, or null where text is absent, malformed or no object."""
    got = F.from_json(text, f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return F.when(text.isNotNull() & F.ltrim(text).startswith("{") & got["_corrupt_record"].isNull(), got)
