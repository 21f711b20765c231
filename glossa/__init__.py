"""glossa: PySpark operators for preparing, sampling, scoring and blending
multilingual text-classification data.

Everything is expressed with DataFrame / SQL operators so that Catalyst plans
the work; Python only runs where a task-side pandas batch is genuinely needed.
"""

__version__ = "0.1.0"
