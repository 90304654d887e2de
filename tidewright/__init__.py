"""Analytics over document monitoring and audit tables, as DataFrame plans."""
