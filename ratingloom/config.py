"""Settings shared by the jobs. Frozen, so a fitted version can name exactly what it used."""

from __future__ import annotations

from dataclasses import dataclass

# They must equal the public data sets' and jobs' for the same results.
SPLIT_SEED = 12345
SAMPLE_SEED = 42
POPULAR_LIMIT = 200
MAX_ITER_A, REG_PARAM_A = 9, 0.05
MAX_ITER_B, REG_PARAM_B = 5, 0.01

# ALS keeps ids as 32-bit integers.
ID_MIN, ID_MAX = -(2**31), 2**31 - 1


@dataclass(frozen=True)
class AlsConfig:
    """Settings of one explicit-feedback fit; all of them go to the model log.

    Nothing here follows the size of the data: starting factors are drawn per block, so the same
    ratings under the same settings give the same model whatever is appended elsewhere and whatever
    the cluster. Choose ``user_blocks`` and ``item_blocks`` once, for the largest size expected;
    MLlib keeps their product in builders of each task, so it should stay in the tens of thousands.
    """

    max_iter: int = MAX_ITER_A
    reg_param: float = REG_PARAM_A
    rank: int = 10
    seed: int = SPLIT_SEED
    user_blocks: int = 8
    item_blocks: int = 8
    # ``mllib``, or ``grouped_sums`` for ratings of which one key holds more than a block can.
    solver: str = "mllib"
    checkpoint_interval: int = 5
    # MLlib holds a block as arrays: a fit is refused, not rerouted, if a key or the average block
    # has more rows than this.
    max_rows_per_block: int = 50_000_000
    # In grouped sums, keys with more (user, item) pairs than this are summed before they move.
    hot_pairs: int = 1_000_000


PRESET_A = AlsConfig()
PRESET_B = AlsConfig(max_iter=MAX_ITER_B, reg_param=REG_PARAM_B)


@dataclass(frozen=True)
class SplitConfig:
    """Train/test split: ``train_buckets`` out of ``buckets`` content-hash buckets train."""

    seed: int = SPLIT_SEED
    buckets: int = 10
    train_buckets: int = 8
