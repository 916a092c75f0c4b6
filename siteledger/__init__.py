"""Location-group analytics on PySpark: cleaning, conforming, modelling and reporting.

Every operator is a DataFrame-to-DataFrame function whose column names are
parameters.  Nothing here runs an action unless its docstring says so.
"""

__version__ = "0.1.0"
