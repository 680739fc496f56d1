"""postclust: question/answer posting clusters as Spark DataFrame jobs.

Postings (questions and answers) are joined into best-answer scores per
question, turned into integer (language, score) points, clustered with an exact
integer k-means, and summarized per cluster. Every step is a DataFrame
transformation built from Spark's own expressions and aggregates.
"""

from postclust.params import Params

__all__ = ["Params"]
