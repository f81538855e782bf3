"""Property-valuation analytics as plain Spark DataFrame functions.

Sub-packages:

* ``functions`` - column functions (scalars, address keys, geometry)
* ``sources``   - landed files in, files out
* ``operators`` - DataFrame-to-DataFrame operators (joins, gaps, ranking, upserts)
* ``plans``     - composite jobs built from the operators
"""

from parcel_comps.profiles import BATCH, SERVICE, Profile, get_profile

__all__ = ["BATCH", "SERVICE", "Profile", "get_profile"]
