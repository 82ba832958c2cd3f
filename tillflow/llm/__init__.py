"""Operators for preparing large text corpora as training data.

Nothing outside this subpackage imports it. Each module holds one operator;
``queries`` registers them for the driver.
"""
