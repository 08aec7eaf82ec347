"""Operators over sequences, frames, boxes and embeddings: DataFrame in, DataFrame out.

Every order is total, so results don't depend on how rows are dealt.  Random choices order by md5 of a seed and a key.
"""
