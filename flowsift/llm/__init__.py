"""Operations of a training-data pipeline over document and vector tables.

Nothing else in the library imports this subpackage; it may use the general helpers of
``flowsift.session``. Every operator takes DataFrames and column names and returns a DataFrame;
``queries.py`` binds them to the driver's tables.
"""
