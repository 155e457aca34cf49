"""User-visible parameters of the pipeline, in one frozen dataclass."""

from __future__ import annotations

from dataclasses import dataclass, field


# Fixed values that must equal the original pipeline's defaults.
FALLBACK_PARAMS = (0.0001, 8.0, 0.03, 10.0, 0.4)  # a, b, c, d, e
CALL_MIN_DEPTH = 10  # depth <= 10 is never called
CALL_MIN_RATIO = 0.1  # ratio < 0.1 is never called
BACKGROUND_FLOOR = 0.0001  # background rate floor in the chi-square test
EXPECTED_FLOOR = 1e-10  # floor of expected counts in the chi-square test
FIT_DEPTH_MAX = 100_000  # fit points use 1 <= depth < 100000
GC_LOW, GC_HIGH = 20, 80  # gc bins: <20 % -> 0, >80 % -> 100 (percent units)
GROUP_MIN_DEPTH = 20  # pooled depth for the replicate-group test
GROUP_ERROR_RATE = 0.01  # binomial success probability of the group test
MERGE_MIN_DEPTH = 3  # merge: max depth over required samples
MERGED_MIN_DEPTH = 1  # liftover merge: summed depth (pipeline value)
MIN_READ_LEN = 20  # reads shorter than this after clipping are "too short"
SIGNAL_POS = 18  # 1-based probe position of the spike-in signal base
PROBE_MIN_SUPPORT = 5  # Yf + Zf >= 5
RATIO_BINS = 50
DEPTH_BINS = 50
DEPTH_HIST_MIN_MAX = 1000


@dataclass(frozen=True)
class Options:
    """Parameters of one run.  Defaults follow the original pipeline."""

    ref_base: str = "A"
    mut_base: str = "G"
    merge_min_depth: int = MERGE_MIN_DEPTH
    merged_min_depth: int = MERGED_MIN_DEPTH
    call_min_depth: int = CALL_MIN_DEPTH
    call_min_ratio: float = CALL_MIN_RATIO
    group_min_depth: int = GROUP_MIN_DEPTH
    group_error_rate: float = GROUP_ERROR_RATE
    fit_depth_max: int = FIT_DEPTH_MAX
    fallback_params: tuple = FALLBACK_PARAMS
    min_read_len: int = MIN_READ_LEN
    # read-level accept rules
    premap_min_aligned: int = 30  # qlen - sclen >= 30
    premap_xm_factor: int = 15  # XM * 15 < qlen - sclen
    remap_max_mismatch_rate: float = 0.08  # (NS + 0.2 NC) / qlen <= 0.08
    remap_nc_weight: float = 0.2
    mainmap_min_mapped_ratio: float = 0.8
    mainmap_max_mismatches: int = 6
    mainmap_max_converted_ratio: float = 0.33
    # samples that only annotate (left-joined) in the merge
    skip_samples: tuple = field(default_factory=tuple)
    # replicate groups: tuple of (group, (sample, ...))
    groups: tuple = field(default_factory=tuple)

    @property
    def target_base(self) -> str:
        return self.ref_base.upper()

    @staticmethod
    def from_base_change(base_change: str = "A,G", **kw) -> "Options":
        ref, mut = [b.strip().upper() for b in base_change.split(",")]
        return Options(ref_base=ref, mut_base=mut, **kw)
