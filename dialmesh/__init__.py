"""Contact-data processing on Spark DataFrames.

Captured web pages and CSV lists go in; links, phone numbers, a company table
and ranked search results come out.  Every operator maps DataFrames to
DataFrames and leaves the physical plan to Catalyst.
"""

__version__ = "0.1.0"
