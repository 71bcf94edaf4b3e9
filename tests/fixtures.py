"""Documents of the shapes that the readers expect, with values made up for these tests."""

from __future__ import annotations

import json

MODEL = "mlx-community/Sparrow-2.5-Mini-6bit"
SLUG = "mlx-community-sparrow-2-5-mini-6bit"
TASK = "river_crossing"

TASK_DOCUMENT = json.dumps(
    {
        "model_name": MODEL,
        "date": 1750000000.0,
        "total_evaluation_time_seconds": "61.75",
        "results": {
            TASK: {
                "exact_match,strict-match": 0.25,
                "exact_match,flexible-extract": 0.375,
                "exact_match_stderr,flexible-extract": 0.0625,
                "alias": "River crossing",
            }
        },
        "config": {
            "seed": [7, 8],
            "limit": 16,
            "gen_kwargs": {"temperature": 0.5, "max_gen_toks": 2000},
            "model_args": {"model": MODEL},
        },
    }
)

_SERVING = {"duration": 12.5, "completed": 40, "total_input_tokens": 5000, "total_output_tokens": 8000, "request_throughput": 3.25,
            "output_throughput": 640.0, "total_token_throughput": 1040.0}
for _n, _measure in enumerate(("ttft", "tpot", "itl", "e2el"), start=1):
    _SERVING |= {f"mean_{_measure}_ms": 10.5 * _n, f"median_{_measure}_ms": 10.0 * _n, f"p99_{_measure}_ms": 30.0 * _n}
SERVING_DOCUMENT = json.dumps(_SERVING)

VALID_ENVELOPE = json.dumps(
    {
        "schema_version": "1",
        "timestamp": "2025-03-14T15:09:26Z",
        "git_sha": "5eed5eed",
        "trigger": "local",
        "suite": "reasoning",
        "model": MODEL,
        "system": {"os": "os 9", "chip": "chip 3", "memory_gb": 96},
        "gen_kwargs": {"temperature": 0.5, "max_gen_toks": 2000},
        "results": [
            {
                "name": TASK,
                "metric": "exact_match_flexible",
                "value": 0.375,
                "unit": "ratio",
                "duration_seconds": 61.75,
                "tags": {"lm_eval_key": "exact_match,flexible-extract", "n_limit": "16"},
            }
        ],
        "errors": [],
    }
)

INVALID_ENVELOPE = json.dumps(
    {"schema_version": "9", "timestamp": "last Tuesday", "git_sha": "?", "trigger": "whim", "suite": "cooking", "model": MODEL,
     "system": {"os": "os 9", "chip": "chip 3"}, "results": []}
)
