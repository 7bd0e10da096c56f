"""Texts of well-known short licences, without copyright lines and titles, and the
one-line notices by which longer ones are applied."""

WARRANTY_MIT = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

""" + WARRANTY_MIT

MIT_0 = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so.

""" + WARRANTY_MIT

WARRANTY_ISC = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

""" + WARRANTY_ISC

BSD_0 = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

""" + WARRANTY_ISC

BSD_HEAD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.

"""

BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.

"""

BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In
no event will the authors be held liable for any damages arising from the use
of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely,
subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim
that you wrote the original software. If you use this software in a product,
an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

NOTICES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "This work is licensed under the Apache License, Version 2.0."),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",
                     "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",
                "Licensed under the GNU General Public License, version 2."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the GNU General Public License, version 3."),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, version 2.0."),
}

KNOWN = [
    ("0BSD", BSD_0),
    ("BSD-2-Clause", BSD_HEAD + BSD_TAIL),
    ("BSD-3-Clause", BSD_HEAD + BSD_NAMES + BSD_TAIL),
    ("ISC", ISC),
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT-0", MIT_0),
    ("Zlib", ZLIB),
    *((license_id, notice) for license_id, notices in NOTICES.items() for notice in notices),
]


#: Notices of more than one line by which longer licences are applied.
HEADERS = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    *((f"GPL-{version}", f"""This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version {version[0]} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program{end}""")
      for version, end in (("2.0", "; if not, write to the Free Software Foundation, Inc.,\n"
                                   "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."),
                                  ("2.0", ".  If not, see <https://www.gnu.org/licenses/>."),
                                  ("3.0", ".  If not, see <https://www.gnu.org/licenses/>."))),
]

#: licence, first word and digest of the canonical form of whole texts that are too long to be held
#: here, as the Debian package base-files has them in /usr/share/common-licenses: each as it stands and,
#: where it has an appendix on how to apply it, up to and before "END OF TERMS AND CONDITIONS". They
#: must be made anew when the canonical form changes.
LONG = [
    ("Apache-2.0", "apache", "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2"),
    ("Apache-2.0", "apache", "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0"),
    ("Apache-2.0", "apache", "37599287c15c2f2ec060c3c3b55bdf69e3bc7a8aeeb9cd57e18800088789538a"),
    ("Artistic-1.0-Perl", "the", "bc4d0c00d493021b9f3b1041689fa28b4bf980cf2e37601f7cb475a7265e3b93"),
    ("CC0-1.0", "creative", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "gnu", "b6270c129be9b0e0172ebf4f39b974d927f155b0569e6689a4fd15068977ecdd"),
    ("GFDL-1.3", "gnu", "7a546845f0b9175c013adbd275ab046668c2cd62fa85809f866f6d3218d6adcd"),
    ("GPL-1.0", "gnu", "ecede0ce378cc2fefec4431f4cf508af5338dc8a3e44b5c5a3a7867070db5798"),
    ("GPL-1.0", "gnu", "6c07dfb5e6ddc39fe93ae803d39b67367c21b50207b645111c04cd08cb283d70"),
    ("GPL-1.0", "gnu", "3c796b04cfbd58d45e505bbfd656f39ed02b0e66f4b7768a6c92eb29931304c8"),
    ("GPL-2.0", "gnu", "c9150a998ddbe45123303bf71d093beee4baf803b1eaea84b34fd41189285f1f"),
    ("GPL-2.0", "gnu", "f79b9e516923cc213c21d12fd8a51b4067992b2728a442e31fd53d078dd25632"),
    ("GPL-2.0", "gnu", "b1a13b5262988058eb24fa2ecc2451ae813514d152b9361d66a115e43a210bf9"),
    ("GPL-3.0", "gnu", "ee0d2b91860148fdc6916d4fbea5723c7b0c7330d7a45ee71fabe123ce7175f8"),
    ("GPL-3.0", "gnu", "4a9083dfa89bea4f460e373a4c7a4645205d5e3d3be775d544b10357e357f57b"),
    ("GPL-3.0", "gnu", "7ffc4b405b2d22c9a01c3a22db88495dbca721fad42a69191637c049f0108153"),
    ("LGPL-2.0", "gnu", "bea988245c65edbddad6f43ff12ca2472c232324e916d42648b90eac944d833e"),
    ("LGPL-2.0", "gnu", "7d5246cc24a9d78fffd01a07fbc2e71edd1e94ad8d403f3180a4cf5fef43d389"),
    ("LGPL-2.0", "gnu", "3ea7beb964a4396aa5ad75de90dd58ff01913b237f397517e8563b7acf07d87c"),
    ("LGPL-2.1", "gnu", "ed875dac9045cba09a17867210991f3a4a82f80b82096b054560a3a8dae9d692"),
    ("LGPL-2.1", "gnu", "65484d3c9f900f96945bd4e6c5397aaa24f93bdc8f720eae06fbd377c62cfe97"),
    ("LGPL-2.1", "gnu", "9c2c2afdce244f7835e438f43966f864ce47d82ebd6316bbcb123927f3280e30"),
    ("LGPL-3.0", "gnu", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "mozilla", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", "mozilla", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
]
