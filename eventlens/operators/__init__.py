"""DataFrame -> DataFrame operators.  Each runs unchanged on a batch table or a
streaming DataFrame unless its docstring says otherwise."""
