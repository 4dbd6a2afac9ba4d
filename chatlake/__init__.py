"""chatlake: chat-corpus preparation and tool-call evaluation on Spark.

Every public function takes and returns DataFrames or Columns; nothing here
collects rows to the driver.
"""

__version__ = "0.1.0"
