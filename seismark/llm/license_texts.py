"""Notices that the license scan looks for."""

from __future__ import annotations

# Phrases that count wherever they stand, and the label of each.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Wording of common notices and the label of each. They are public texts.
NOTICES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
     "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights "
     "to this software to the public domain worldwide."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved. No part of this work may be reproduced without permission."),
]
