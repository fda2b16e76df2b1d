"""Operators: frames and keyword parameters in, one frame out.

They run no action, but for the joins that measure their small side.
"""
