"""casetrace - case-record normalisation and reporting on Spark.

Load a flat case feed, normalise it into a keyed model with re-runnable
insert-if-absent loads and constraint checks, and run parameterised reports
over it; all in the DataFrame API on built-in functions.
"""

__version__ = "0.1.0"
